"""Relational building blocks shared by the reports.

The reports are plain DataFrame plans; these helpers name the few shapes
that recur and carry the scale reasoning once:

* dimensions are joined by key and left to AQE, which broadcasts a side only
  when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
  and sort-merge joins it otherwise (with skewed partitions split);
* there is no explicit broadcast and no cross join: a value derived from a
  global aggregate (a grand total) is a scalar subquery;
* aggregation happens before a join wherever the join key is the group key,
  so the shuffle carries partial sums instead of raw rows and a hot key is
  combined map-side instead of landing whole in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exists_in(df: DataFrame, dim: DataFrame, left_key: str | Column,
              right_key: str, distinct_keys: bool = False) -> DataFrame:
    """JOIN-10: keep rows whose key exists in ``dim`` (no fan-out).

    ``distinct_keys=True`` when ``dim`` repeats its keys (a fact table used
    as a filter): the keys are de-duplicated first, with a partial
    aggregate, so the join's build side holds each key once.
    """
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    keys = dim.select(F.col(right_key).alias("__k")).where(F.col("__k").isNotNull())
    if distinct_keys:
        keys = keys.distinct()
    return df.join(keys, lk == F.col("__k"), "left_semi")


def missing_from(df: DataFrame, dim: DataFrame, left_key: str | Column,
                 right_key: str, require: str | None = None) -> DataFrame:
    """JOIN-7: rows whose key has no partner in ``dim``.

    Equals the ``LEFT JOIN dim ... WHERE dim.<require> IS NULL`` idiom when
    ``require`` names the tested column: partners with a NULL there do not
    count as partners.
    """
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    right = dim
    if require is not None:
        right = right.where(F.col(require).isNotNull())
    keys = right.select(F.col(right_key).alias("__k"))
    return df.join(keys, lk == F.col("__k"), "left_anti")


def lookup(df: DataFrame, dim: DataFrame, left_key: str, right_key: str,
           columns: Sequence[str], how: str = "left") -> DataFrame:
    """JOIN-2/4: add dimension attributes by key (dimension keys are unique)."""
    right = dim.select(F.col(right_key).alias("__k"), *columns)
    return df.join(right, F.col(left_key) == F.col("__k"), how).drop("__k")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1: UNION ALL by position; names come from the first frame."""
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out
