"""Table models: materialised aggregates and the invoice load job.

RPT-17..19 with SNK-4..7. Each model writes a Parquet table and returns the
table read back, so the caller sees what was stored and the lineage of the
result starts at the written files.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import DateLike, as_of_or_today, money
from ..sources.extract import write_parquet


def materialize(df: DataFrame, path: str, sort_by: Sequence[str] = (),
                mode: str = "overwrite") -> DataFrame:
    """SNK-4: ``materialized='table'``; ``sort`` orders rows by key.

    Range partitioning on the sort key gives globally ordered part files
    without one task holding everything.
    """
    out = df.repartitionByRange(*sort_by) if sort_by else df
    write_parquet(out, path, mode=mode, sort_within=sort_by)
    return df.sparkSession.read.parquet(path)


def total_revenue(orders: DataFrame, revenue_col: str, path: str) -> DataFrame:
    """RPT-17: total revenue as a one-row table (exact decimal sum)."""
    total = orders.agg(money(F.sum(F.col(revenue_col).cast(C.MONEY))).alias("total_revenue"))
    return materialize(total, path)


def count_by_key(df: DataFrame, key: str, path: str, key_name: str | None = None,
                 count_name: str = "total_books") -> DataFrame:
    """RPT-19: rows per key as a table sorted by key."""
    name = key_name or key
    counts = df.groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias(count_name))
    return materialize(counts, path, sort_by=[name])


def sales_invoice_load(sales_invoice: DataFrame, target_path: str,
                       as_of: DateLike | None = None, load_id: str | None = None) -> DataFrame:
    """RPT-18: stamp ``last_updated``, upper-case the customer name, append.

    The source copies the table into a temporary table, updates every row
    and inserts the copy into the target (SNK-5/6/7). As a DataFrame the
    copy is the plan itself: one projection, one write. The target is
    partitioned by day and ``load_id``; a load replaces only its own
    partition, so all earlier loads stay, those of the same day too, and a
    load that is run again under its id does not double its rows. Without an
    id every call is a load of its own.
    """
    loaded = sales_invoice.withColumns({
        "last_updated": as_of_or_today(as_of),
        "load_id": F.lit(load_id or uuid.uuid4().hex),
        "customer_name": F.upper(F.col("customer_name")),
    })
    write_parquet(loaded, target_path, partition_by=["last_updated", "load_id"],
                  replace_partitions=True)
    return sales_invoice.sparkSession.read.parquet(target_path)
