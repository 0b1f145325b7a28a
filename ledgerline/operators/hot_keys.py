"""Lookups of keys of which a few hold much of the fact table (JOIN-2, JOIN-4).

A shuffle join sends all rows of a key to one task. Adaptive execution can cut
such a task in a session that is set up for it; here the plan itself does, in
any session. A frequent-items sketch over the fact's key (one pass, a fixed
number of counters) names the keys that may be hot. Their dimension rows, one
each, are broadcast; all other rows are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot above one in ``HOT_PARTS`` rows; the sketch follows so many keys.
HOT_PARTS, COUNTERS = 200, 4096


def frequent_keys(rows: DataFrame, key: str, parts: int = HOT_PARTS, counters: int = COUNTERS) -> list:
    """Keys that hold more than one in ``parts`` rows, at most ``parts`` of
    them and possibly some that hold a little less; null is none."""
    found = rows.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {parts}, {counters})").alias("top"),
        F.count(F.lit(1)).alias("n")).first()
    return [x["item"] for x in found["top"] or () if x["count"] * parts > found["n"]]


def lookup_spread(fact: DataFrame, dim: DataFrame, left_key: str, right_key: str,
                  columns: Sequence[str], how: str = "left", parts: int = HOT_PARTS,
                  counters: int = COUNTERS) -> DataFrame:
    """``relational.lookup`` for a fact whose keys may be hot: dimension
    attributes by key (the dimension's keys are unique). ``how`` is ``left`` or
    ``inner``. Rows without a key never meet the dimension, so they do not
    gather in one task either."""
    side = dim.select(F.col(right_key).alias("__k"), *columns)
    hot = frequent_keys(fact, left_key, parts, counters)
    held = F.col(left_key).isin(hot) if hot else F.lit(False)
    rest = fact.where(F.col(left_key).isNotNull() & ~held)
    out = rest.join(side, F.col(left_key) == F.col("__k"), how).drop("__k")
    if hot:
        few = F.broadcast(side.where(F.col("__k").isin(hot)))      # at most ``parts`` rows
        out = out.unionByName(fact.where(held).join(few, F.col(left_key) == F.col("__k"), how).drop("__k"))
    if how == "left":
        out = out.unionByName(fact.where(F.col(left_key).isNull()), allowMissingColumns=True)
    return out
