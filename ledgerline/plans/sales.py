"""Sales reports: daily/weekly sales, customer share, item report, delivery
targets and month-to-date target trackers."""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import (DateLike, as_of_or_today, convert_currency, daily_target,
                                 date_lit, days_in_month, first_non_blank, load_ladder,
                                 money, null_of, ratio, tax_inclusive_rate, tax_per_item,
                                 week_sunday)
from ..operators.aggregates import (detail_and_total, detail_with_summaries,
                                    grouped_with_text_max, running_sum, with_grand_total)
from ..operators.calendar import month_calendar
from ..operators.relational import exists_in

NO_NOTE = "\x00"        # begins no document name


def _submitted(sales_invoice: DataFrame, where: Column | None = None) -> DataFrame:
    cond = F.col("docstatus") == C.SUBMITTED
    if where is not None:
        cond = cond & where
    return sales_invoice.where(cond)


def posting_between(start: DateLike | None = None, end: DateLike | None = None) -> Column | None:
    """FLT-14: the optional posting-date filter of the BI templates."""
    cond = None
    if start is not None:
        cond = F.col("posting_date") >= date_lit(start)
    if end is not None:
        c = F.col("posting_date") <= date_lit(end)
        cond = c if cond is None else cond & c
    return cond


# ---------------------------------------------------------------------------
# RPT-8 / RPT-10: daily and weekly sales
# ---------------------------------------------------------------------------

def daily_sales(sales_invoice: DataFrame, where: Column | None = None) -> DataFrame:
    """RPT-8: submitted sales per posting date, ascending."""
    return (_submitted(sales_invoice, where)
            .groupBy("posting_date")
            .agg(money(F.sum("base_grand_total")).alias("TOTAL_DAILY_SALES"))
            .orderBy("posting_date"))


def weekly_sales(sales_invoice: DataFrame, where: Column | None = None,
                 with_year: bool = False) -> DataFrame:
    """RPT-10: submitted sales per Sunday-based week number.

    As in the source, weeks of different years share a number unless
    ``with_year=True`` adds the year to the key.
    """
    keys = [week_sunday("posting_date").alias("week_no")]
    if with_year:
        keys.insert(0, F.year("posting_date").alias("year_no"))
    return (_submitted(sales_invoice, where)
            .groupBy(*keys)
            .agg(money(F.sum("base_grand_total")).alias("total_weekly_sales")))


# ---------------------------------------------------------------------------
# RPT-9: customer contribution
# ---------------------------------------------------------------------------

def _not_opening(literal: bool) -> Column:
    """The source compares the text flag with 0, read here as "not an opening
    entry". The database turns a text without digits into 0 first, so that
    there the comparison holds for every flag: ``literal`` reads it that way."""
    return F.col("is_opening").isNotNull() if literal else F.col("is_opening") == C.NOT_OPENING


def customer_contribution(sales_invoice: DataFrame, start: DateLike, end: DateLike,
                          literal_opening: bool = False) -> DataFrame:
    """RPT-9: sales per customer and its share of all sales in the period."""
    si = _submitted(sales_invoice,
                    _not_opening(literal_opening)
                    & ~F.col("status").isin(*C.INVOICE_STATUS_RETURN)
                    & posting_between(start, end))
    per_customer = (si.groupBy("customer", "customer_name")
                      .agg(F.sum("base_grand_total").alias("total_sales_per")))
    with_total = with_grand_total(per_customer, "total_sales_per", "total_sales_revenue")
    return (with_total.select(
                "customer", "customer_name",
                money("total_sales_per").alias("total_sales_per"),
                money("total_sales_revenue").alias("total_sales_revenue"),
                (ratio("total_sales_per", "total_sales_revenue") * 100).alias("percentage"))
            .orderBy(F.col("total_sales_per").desc()))


# ---------------------------------------------------------------------------
# RPT-11: item-wise sales report
# ---------------------------------------------------------------------------

def item_sales_report(t, start: DateLike | None = None, end: DateLike | None = None,
                      customers: Sequence[str] | None = None,
                      dedupe_team: bool = False, literal_opening: bool = False) -> DataFrame:
    """RPT-11: one row per invoice line (and sales person), with tax.

    A customer with several sales-team rows repeats its lines, as in the
    source; ``dedupe_team=True`` keeps one row per sales person instead of
    per team row.
    """
    cond = _not_opening(literal_opening)
    period = posting_between(start, end)
    if period is not None:
        cond = cond & period
    if customers is not None:
        cond = cond & F.col("customer").isin(*customers)
    si = _submitted(t.sales_invoice, cond).select(
        F.col("name").alias("sales_invoice_id"), F.col("customer").alias("customer_code"),
        "customer_name", "posting_date", "due_date", "export_series", "etr_invoice_number",
        "tax_category", "status", "tax_id",
        tax_per_item("base_total_taxes_and_charges", "total_qty").alias("tax_per_item"))

    # The team meets the headers, so the lines are shuffled by invoice once.
    team = t.sales_team.select(F.col("parent").alias("__st"), F.col("sales_person"))
    if dedupe_team:
        team = team.distinct()
    si = si.join(team, F.col("customer_code") == F.col("__st"), "left").drop("__st")
    lines = t.sales_invoice_item.join(si, F.col("parent") == F.col("sales_invoice_id"))

    vehicles = t.delivery_note.select(
        F.col("name").alias("__dn"),
        first_non_blank("company_vehicle", "customer_provided_vehicle",
                        "transporter_vehicle_number").alias("vehicle_number"))
    # Lines without a delivery note find none; a key of their own spreads
    # them over the partitions of the join.
    key = F.coalesce(F.col("delivery_note"), F.concat(
        F.lit(NO_NOTE), F.pmod(F.xxhash64("parent", "item_code", "qty"), F.lit(4096)).cast("string")))
    lines = (lines.withColumn("__key", key).join(vehicles, F.col("__key") == F.col("__dn"), "left")
             .drop("__key", "__dn"))

    rate = F.col("base_rate").cast("double") + F.col("tax_per_item")
    return (lines.select(
                "sales_invoice_id", F.col("delivery_note").alias("delivery_note_id"),
                "customer_code", "customer_name",
                F.col("sales_person").alias("sales_person_name"),
                "posting_date", "due_date", "vehicle_number", "export_series",
                "etr_invoice_number", "tax_category", "status", "tax_id",
                "item_code", "item_name",
                money("qty").alias("Quantity_in_UOM"),
                money("tonnes_input").alias("Qty_in_Tonnes"),
                money("base_rate").alias("rate_before_tax"),
                money("base_amount").alias("amount_before_tax"),
                "tax_per_item",
                rate.alias("rate_after_tax"),
                (rate * F.col("qty").cast("double")).alias("amount_after_tax"))
            # Ties under the invoice id are in no particular order in the
            # source; the extra keys let the range partitioner split an
            # invoice with very many lines instead of sorting it in one task.
            .orderBy("sales_invoice_id", "item_code", "delivery_note_id", "sales_person_name",
                     "Quantity_in_UOM", "rate_before_tax"))


# ---------------------------------------------------------------------------
# RPT-12 / RPT-15: delivery targets from open sales orders
# ---------------------------------------------------------------------------

def open_order_lines(t, as_of: DateLike | None, days: int, taxed_template: str,
                     tax_factor: Decimal = C.TAX_FACTOR,
                     max_delivered: int = C.MAX_PERCENT_DELIVERED,
                     transport_item: str = C.TRANSPORT_ITEM,
                     dedupe_team: bool = False) -> DataFrame:
    """Open order lines of recent orders with their truck-load quantity.

    Columns: sales_order_id, order_date, delivery_date, customer_name,
    sales_person, item_code, item_name, quantity_in_tonnes, product_amount
    (exact decimals). Orders with several sales-team rows repeat their lines,
    as in the source; ``dedupe_team=True`` keeps one row per sales person.
    """
    day = as_of_or_today(as_of)
    so = t.sales_order.where((F.col("docstatus") == C.SUBMITTED)
                             & (F.col("per_delivered") <= max_delivered)
                             & (F.to_date("transaction_date") >= F.date_sub(day, days))
                             & ~F.col("status").isin(*C.ORDER_STATUS_CLOSED))
    so = so.select(F.col("name").alias("sales_order_id"),
                   F.to_date("creation").alias("order_date"), "delivery_date",
                   "customer_name", "currency", "conversion_rate")
    remaining = F.col("qty") - F.col("delivered_qty")
    team = t.sales_team.select(F.col("parent").alias("__st"), "sales_person")
    if dedupe_team:
        team = team.distinct()
    so = so.join(team, F.col("sales_order_id") == F.col("__st"), "left").drop("__st")
    soi = t.sales_order_item.where((F.col("item_code") != transport_item) & (remaining > 0))
    lines = so.join(soi, F.col("sales_order_id") == F.col("parent"))

    rate = tax_inclusive_rate("rate", "item_tax_template", taxed_template, tax_factor)
    product_rate = convert_currency(rate, "currency", "conversion_rate").cast("decimal(20,6)")
    bags = load_ladder(remaining, "weight_per_unit", "currency")
    return lines.select(
        "sales_order_id", "order_date", "delivery_date", "customer_name", "sales_person",
        "item_code", "item_name",
        (F.col("weight_per_unit") * bags).alias("quantity_in_tonnes"),
        (bags * product_rate).alias("product_amount"))


def _sales_on(t, day: Column) -> DataFrame:
    """Submitted sales of one day for known companies and customers (one row)."""
    si = _submitted(t.sales_invoice, F.col("posting_date") == day)
    si = exists_in(si, t.company, "company", "name")
    si = exists_in(si, t.customer, "customer", "name")
    return si.agg(F.sum("base_grand_total").alias("sales_today"))


def _summary_rows(t, day: Column, names: list[str], rows: list[list[Column]]) -> DataFrame:
    """Today's-sales and target rows, both from one aggregate of today's sales."""
    today = _sales_on(t, day)
    structs = [F.struct(*[c.alias(n) for c, n in zip(r, names)]) for r in rows]
    return today.select(F.inline(F.array(*structs)))


def delivery_targets(t, as_of: DateLike | None = None, taxed_template: str = "",
                     monthly_target: int = 0, days: int = C.DELIVERY_WINDOW_DAYS,
                     target_days: int = C.TARGET_DAYS_FIXED,
                     dedupe_team: bool = False) -> DataFrame:
    """RPT-12: quantities to deliver per customer and item, plus three rows:
    the potential total, today's sales and the daily sales target."""
    day = as_of_or_today(as_of)
    lines = open_order_lines(t, as_of, days, taxed_template, dedupe_team=dedupe_team)
    detail = (grouped_with_text_max(
                  lines, ["customer_name", "item_code", "item_name"], ["sales_person"],
                  {"total_quantity_tonnes": ("sum", F.col("quantity_in_tonnes")),
                   "total_amount": ("sum", F.col("product_amount"))})
              .withColumn("total_quantity_tonnes", F.round("total_quantity_tonnes", 2)))
    blank = F.lit("")
    both = detail_and_total(
        detail, ["customer_name", "item_code", "item_name", "sales_person"],
        ["total_quantity_tonnes", "total_amount"],
        {"customer_name": F.lit(C.LABEL_POTENTIAL), "item_code": blank, "item_name": blank,
         "sales_person": blank},
        {"total_quantity_tonnes": lambda c: F.round(c, 2)})
    detail_out = both.select("customer_name", "item_code", "item_name", "sales_person",
                             money("total_quantity_tonnes").alias("total_quantity_tonnes"),
                             money("total_amount").alias("total_amount"))
    names = ["customer_name", "item_code", "item_name", "sales_person",
             "total_quantity_tonnes", "total_amount"]
    rows = _summary_rows(t, day, names, [
        [F.lit(C.LABEL_SALES_TODAY), blank, blank, blank, null_of("double"),
         money("sales_today")],
        [F.lit(C.LABEL_SALES_TARGET), blank, blank, blank, null_of("double"),
         money(daily_target(monthly_target, target_days))]])
    return detail_with_summaries(detail_out, [rows])


def delivery_targets_by_order(t, as_of: DateLike | None = None, taxed_template: str = "",
                              monthly_target: int = 0,
                              days: int = C.DELIVERY_WINDOW_DAYS_BY_ORDER,
                              target_days: int = C.TARGET_DAYS_FIXED,
                              dedupe_team: bool = False) -> DataFrame:
    """RPT-15: as RPT-12 but per sales order, with the order's age in days."""
    day = as_of_or_today(as_of)
    lines = open_order_lines(t, as_of, days, taxed_template, dedupe_team=dedupe_team)
    detail = (grouped_with_text_max(
                  lines, ["sales_order_id", "customer_name", "item_code", "item_name"],
                  ["sales_person"],
                  {"order_date": ("max", F.col("order_date")),
                   "delivery_date": ("max", F.col("delivery_date")),
                   "total_quantity_tonnes": ("sum", F.col("quantity_in_tonnes")),
                   "total_amount": ("sum", F.col("product_amount"))})
              .withColumn("total_quantity_tonnes", F.round("total_quantity_tonnes", 2)))
    blank, no_date, no_int = F.lit(""), null_of("date"), null_of("int")
    keys = ["sales_order_id", "order_date", "delivery_date", "customer_name", "item_code",
            "item_name", "sales_person", "days_since_order_date"]
    detail = detail.withColumn("days_since_order_date", F.datediff(day, F.col("order_date")))
    both = detail_and_total(
        detail, keys, ["total_quantity_tonnes", "total_amount"],
        {"sales_order_id": F.lit(C.LABEL_TOTALS), "order_date": no_date, "delivery_date": no_date,
         "customer_name": blank, "item_code": blank, "item_name": blank, "sales_person": blank,
         "days_since_order_date": no_int},
        {"total_quantity_tonnes": lambda c: F.round(c, 2)})
    detail_out = both.select(*keys, money("total_quantity_tonnes").alias("total_quantity_tonnes"),
                             money("total_amount").alias("total_amount"))
    rows = _summary_rows(t, day, [*keys, "total_quantity_tonnes", "total_amount"], [
        [F.lit(C.LABEL_SALES_TODAY), no_date, no_date, blank, blank, blank, blank, no_int,
         null_of("double"), money("sales_today")],
        [F.lit(C.LABEL_SALES_TARGET_TODAY), no_date, no_date, blank, blank, blank, blank,
         no_int, null_of("double"), money(daily_target(monthly_target, target_days))]])
    return detail_with_summaries(detail_out, [rows])


# ---------------------------------------------------------------------------
# RPT-13 / RPT-14: month-to-date sales-target trackers
# ---------------------------------------------------------------------------

def _month_sales(sales_invoice: DataFrame, day: Column) -> DataFrame:
    """Submitted sales per day of the month of ``day``.

    ``MONTH(d) = MONTH(today) AND YEAR(d) = YEAR(today)`` is written as a
    date range so the predicate reaches the scan (FLT-12).
    """
    si = _submitted(sales_invoice, F.col("posting_date").between(F.trunc(day, "MM"),
                                                                   F.last_day(day)))
    return si.groupBy("posting_date").agg(F.sum("base_grand_total").alias("sales_today"))


def _of_month(daily: DataFrame, day: Column) -> DataFrame:
    return daily.where(F.col("posting_date").between(F.trunc(day, "MM"), F.last_day(day)))


def target_tracker(sales_invoice: DataFrame, as_of: DateLike | None = None,
                   monthly_target: int = 0) -> DataFrame:
    """RPT-13: cumulative sales against the cumulative target, days with sales.

    The target accumulates only on days with sales; the deficit is spread
    over the days left in the month (NULL on the last day).
    """
    day = as_of_or_today(as_of)
    return tracker_of_days(_month_sales(sales_invoice, day), as_of, monthly_target)


def tracker_of_days(daily: DataFrame, as_of: DateLike | None = None,
                    monthly_target: int = 0) -> DataFrame:
    """RPT-13 from sales per day (``posting_date``, ``sales_today``)."""
    day = as_of_or_today(as_of)
    target = daily_target(monthly_target, days_in_month(day))
    daily = _of_month(daily, day)
    tracked = daily.select(
        "posting_date", "sales_today",
        running_sum("sales_today", "posting_date").alias("cumulative_sales"),
        running_sum(target, "posting_date").alias("sales_target_cumulative"))
    deficit = F.col("sales_target_cumulative") - F.col("cumulative_sales")
    return (tracked.select(
                "posting_date", money("sales_today").alias("sales_today"),
                money("cumulative_sales").alias("cumulative_sales"),
                money("sales_target_cumulative").alias("sales_target_cumulative"),
                money(deficit).alias("cumulative_deficit"),
                ratio(deficit, F.datediff(F.last_day(day), F.col("posting_date")))
                .alias("spread_per_day"))
            .orderBy("posting_date"))


def calendar_target_tracker(sales_invoice: DataFrame, as_of: DateLike | None = None,
                            monthly_target: int = 0) -> DataFrame:
    """RPT-14: the tracker on every day of the month, with a new daily target
    from today on that spreads today's deficit over the remaining days."""
    day = as_of_or_today(as_of)
    return calendar_tracker_of_days(_month_sales(sales_invoice, day), as_of, monthly_target)


def calendar_tracker_of_days(daily: DataFrame, as_of: DateLike | None = None,
                             monthly_target: int = 0) -> DataFrame:
    """RPT-14 from sales per day (``posting_date``, ``sales_today``)."""
    day = as_of_or_today(as_of)
    target = daily_target(monthly_target, days_in_month(day))
    daily = _of_month(daily, day)
    days = month_calendar(daily.sparkSession, day)
    days = days.join(daily, "posting_date", "left").select(
        "posting_date", F.coalesce(F.col("sales_today"), F.lit(0)).alias("sales_today"))
    tracked = days.select(
        "posting_date", "sales_today",
        target.alias("sales_target"),
        running_sum("sales_today", "posting_date").alias("cumulative_sales"),
        running_sum(target, "posting_date").alias("sales_target_cumulative"))
    deficit = F.col("sales_target_cumulative") - F.col("cumulative_sales")
    # Today's deficit is one value of the (at most 31-row) tracker: a scalar
    # subquery, spread over the days left after today.
    current_deficit = tracked.where(F.col("posting_date") == day).select(deficit).scalar()
    remaining_days = F.datediff(F.last_day(day), day)
    new_target = F.when(F.col("posting_date") >= day,
                        F.col("sales_target").cast("double")
                        + ratio(current_deficit, remaining_days))
    return (tracked.select(
                "posting_date", money("sales_today").alias("sales_today"),
                money("cumulative_sales").alias("cumulative_sales"),
                money(deficit).alias("cumulative_deficit"),
                ratio(deficit, F.greatest(F.datediff(F.last_day(day), F.col("posting_date")),
                                          F.lit(1))).alias("spread_per_day"),
                new_target.alias("new_daily_sales_target"))
            .orderBy("posting_date"))
