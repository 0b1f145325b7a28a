"""Aggregation shapes: latest row per key, detail plus total, running sums."""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """MRG-1: keep the last row of every key, by ``order`` (last wins).

    Written as ``max(struct(order..., payload...))`` per key, a partial and a
    final aggregate: each task ships at most one row per key, so a key holding
    a third of the rows is reduced where it is read. Spark sorts for a maximum
    of structs (it cannot be kept in a hash aggregate's buffer), so every task
    sorts its own rows by key; apply it to what changed, not to a whole
    history (``sources.compaction``). Ties on ``order`` are broken by the
    payload columns, so the result is deterministic.
    """
    payload = [c for c in (columns or df.columns) if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in payload])
    return (df.groupBy(*keys)
              .agg(F.max(packed).alias("__last"))
              .select(*keys, *[F.col(f"__last.o{i}").alias(c) for i, c in enumerate(order)],
                      *[F.col(f"__last.{c}") for c in payload]))


def grouped_with_text_max(df: DataFrame, keys: Sequence[str], text_max: Sequence[str],
                          aggs: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """``groupBy(keys)`` with ``max()`` of string columns (SEM-1), hash-friendly.

    Spark cannot hash-aggregate ``max`` of a string, so a plain aggregate
    falls back to sorting every input row. Here the rows are first grouped
    by ``keys`` plus the text columns (a hash aggregate: strings are fine as
    keys) and the text ``max`` is taken over that small result. ``aggs``
    maps an output name to ``("sum" | "max", column)``; both re-aggregate
    exactly (a sum of sums, a max of maxes, NULL when all inputs are NULL).
    """
    first = df.groupBy(*keys, *text_max).agg(
        *[(F.sum(c) if how == "sum" else F.max(c)).alias(name) for name, (how, c) in aggs.items()])
    return first.groupBy(*keys).agg(
        *[F.max(t).alias(t) for t in text_max],
        *[(F.sum(name) if how == "sum" else F.max(name)).alias(name)
          for name, (how, _c) in aggs.items()])


def with_grand_total(df: DataFrame, value: str, total_name: str) -> DataFrame:
    """WIN-1: ``SUM(value) OVER ()`` on every row, without a window.

    The total is a scalar subquery: a global aggregate (partial sums per
    task, one final row) computed once and placed on every row as a value.
    No single-partition window, no join.
    """
    return df.withColumn(total_name, df.select(F.sum(value)).scalar())


def running_sum(value: str | Column, order_by: str) -> Column:
    """WIN-4: ``SUM(x) OVER (ORDER BY d)`` with the default RANGE frame.

    Only used on per-day aggregates of one month (at most 31 rows), where a
    global ordering is cheap.
    """
    w = Window.orderBy(order_by).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(v).over(w)


def detail_and_total(detail: DataFrame, keys: Sequence[str], values: Sequence[str],
                     total_keys: Mapping[str, Column],
                     total_values: Mapping[str, Callable[[Column], Column]] | None = None
                     ) -> DataFrame:
    """AGG-13: the rows of ``detail`` plus one grand-total row, in one pass.

    ``GROUPING SETS ((keys), ())`` over the detail: the full set returns every
    detail row (``keys`` are unique in ``detail``), the empty set is the total,
    told apart by the grouping id. One seed row without values makes the empty
    set exist when the detail is empty; it never shows itself, being marked by
    a key of its own. ``total_keys`` labels the key columns of the total row;
    ``total_values`` post-processes a total (rounding, for instance).
    """
    total_values = total_values or {}
    seed = detail.sparkSession.range(1).select(
        *[F.lit(None).cast(detail.schema[c].dataType).alias(c) for c in (*keys, *values)],
        F.lit(True).alias("__seed"))
    seeded = detail.select(*keys, *values, F.lit(False).alias("__seed")).unionByName(seed)
    rows = (seeded.groupingSets([[*keys, "__seed"], []], *keys, "__seed")
            .agg(*[F.sum(v).alias(v) for v in values], F.grouping_id().alias("__gid")))
    total = F.col("__gid") != 0
    label = {k: total_keys.get(k, F.lit(None)).cast(detail.schema[k].dataType) for k in keys}
    return rows.where(total | ~F.col("__seed")).select(
        *[F.when(total, label[k]).otherwise(F.col(k)).alias(k) for k in keys],
        *[F.when(total, total_values[v](F.col(v))).otherwise(F.col(v)).alias(v)
          if v in total_values else F.col(v) for v in values])


def detail_with_summaries(detail: DataFrame, summaries: Sequence[DataFrame]) -> DataFrame:
    """AGG-13: detail rows followed by summary rows (UNION ALL by position).

    Summary frames are global aggregates of ``detail`` or of other inputs;
    Spark reuses the detail's shuffle for the summary branch
    (``ReusedExchange``) instead of recomputing it.
    """
    out = detail
    for s in summaries:
        out = out.union(s)
    return out
