"""Purchase reports: raw-material purchases and the items bought."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import money
from ..operators.aggregates import grouped_with_text_max
from ..operators.relational import exists_in


def purchased_lines(t, where: Column | None = None,
                    item_group: str = C.RAW_MATERIALS_GROUP) -> DataFrame:
    """Lines of submitted, non-return purchase invoices of one item group.

    The item group tested is the item master's; both joins only test
    existence (unique keys), so they are semi joins.
    """
    cond = (F.col("docstatus") == C.SUBMITTED) & (F.col("is_return") == C.NOT_RETURN)
    if where is not None:
        cond = cond & where
    invoices = t.purchase_invoice.where(cond)
    items = t.item.where(F.col("item_group") == item_group)
    # the selective dimension first: Spark does not reorder semi joins
    lines = exists_in(t.purchase_invoice_item, items, "item_code", "name")
    return exists_in(lines, invoices, "parent", "name")


def raw_material_purchases(t, where: Column | None = None,
                           item_group: str = C.RAW_MATERIALS_GROUP) -> DataFrame:
    """RPT-16: highest rate and total quantity per item (uom: the largest)."""
    out = grouped_with_text_max(purchased_lines(t, where, item_group), ["item_code", "item_name"],
                                ["uom"], {"rate": ("max", F.col("rate")),
                                          "qty": ("sum", F.col("qty"))})
    return out.select("item_code", "item_name", "uom", money("rate").alias("rate"),
                      money("qty").alias("total_quantity_purchased"))


def purchased_items(t, where: Column | None = None,
                    item_group: str = C.RAW_MATERIALS_GROUP) -> DataFrame:
    """RPT-16b: distinct item codes and names purchased."""
    return (purchased_lines(t, where, item_group)
            .select(F.col("item_code").alias("itm_code"), "item_name").distinct())
