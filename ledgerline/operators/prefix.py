"""Running totals over any number of rows (WIN-3, WIN-4).

A window without partition keys sorts and sums the whole table in one task; one
with keys does the same for a key's history. Here the rows are cut into ranges
of the sort order, wherever the cuts fall. Each range is summed on its own, the
driver gets a few values of each range, carries the totals from one to the next,
and each range adds what was carried to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def running_totals(rows: DataFrame, order: Sequence[str], value: str, name: str,
                   within: Sequence[str] = ()) -> DataFrame:
    """``rows`` with the sum of ``value`` up to and with each row, in the order
    of ``order``, over all rows or within each value of the columns ``within``.

    ``within`` and ``order`` together name a row; rows that tie are summed in
    any order. Nulls sort first and count as 0; the total of no values is 0.
    """
    spark = rows.sparkSession
    keys = [*within, *order]
    kind = dict(rows.select(F.sum(value).alias("s")).dtypes)["s"]
    path = scratch_path(spark, "running")
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.withColumns({"__part": F.spark_partition_id(),
                        "__at": F.monotonically_increasing_id()}).write.parquet(path)
    stored = spark.read.parquet(path)
    added = F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind))
    line = Window.partitionBy("__part", *within).orderBy("__at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summed = stored.withColumn(name, F.sum(added).over(line))
    # a few values of each range: its first and last key, the last key's sum
    key = F.struct(*[F.col(c) for c in within]) if within else F.lit(True)
    edges = summed.groupBy("__part").agg(
        F.min_by(key, "__at").alias("first"), F.max_by(key, "__at").alias("last"),
        F.max_by(name, "__at").alias("sum")).orderBy("__part").collect()
    before, open_key, out = None, None, []
    for e in edges:
        carried = before if e["first"] == open_key else None
        out.append((e["__part"], carried))
        before = e["sum"] + carried if carried is not None and e["first"] == e["last"] else e["sum"]
        open_key = e["last"]
    offsets = F.broadcast(spark.createDataFrame(out, f"__part int, __carried {kind}"))
    # what is carried to a range is for its first key
    if within:
        first = spark.createDataFrame(
            [(e["__part"], *e["first"]) for e in edges],
            "__part int, " + ", ".join(f"`__f{i}` {dict(rows.dtypes)[c]}" for i, c in enumerate(within)))
        offsets = F.broadcast(offsets.join(first, "__part"))
        is_first = F.expr(" AND ".join(f"`{c}` <=> `__f{i}`" for i, c in enumerate(within)))
    else:
        is_first = F.lit(True)
    total = F.col(name) + F.coalesce(F.when(is_first, F.col("__carried")), F.lit(0).cast(kind))
    return summed.join(offsets, "__part").select(*[F.col(f"`{c}`") for c in rows.columns],
                                                 total.cast(kind).alias(name))
