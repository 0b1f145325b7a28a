"""Key checks of increments without the old table (DQ-1, DQ-2).

A Bloom filter over the keys of a table, as rows of bitmaps: small beside the
table, built once and stored, merged by aggregates. All bits of a key lie in one
bitmap, so a key is dealt to that bitmap as one row, both where the filter is
built and where an increment's keys are looked up. A key that misses one of its
bits is certainly new; only keys that find all of them are checked against the
table.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bits per key and bits set for each; 10 and 5 find one new key in a hundred.
BITS_PER_KEY, HASHES = 10, 5
BLOCK_BITS = 32_768     # of one bitmap

#: Bitmaps (of 4 KB) that a task builds side by side; with more it sorts the bits.
BITMAPS_IN_TASK = 16_384
_FALLBACK = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
_LOCK = threading.RLock()


def filter_bits(keys: int, per_key: int = BITS_PER_KEY) -> int:
    """Size of a filter for so many keys: whole bitmaps."""
    return max(1, -(-keys * per_key // BLOCK_BITS)) * BLOCK_BITS


def _block(key: Column, bits: int) -> Column:
    """The bitmap of a key, by the key's hash."""
    return F.pmod(key, F.lit(max(1, bits // BLOCK_BITS)).cast("long"))


def _places(key: Column, hashes: int = HASHES) -> list[Column]:
    """Places of a key's bits in its bitmap, from 0."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS).cast("long")) for i in range(hashes)]


def _written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` worked out once: written to the shared folder and read back."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def key_filter(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(block, bitmap, bits): the filter of the rows' keys, stored. Keys are
    dealt by bitmap before their bits are listed, so a bitmap is built in one
    task and none is shuffled."""
    spark = rows.sparkSession
    hashed = rows.select(F.xxhash64(*keys).alias("key")).distinct().select(
        _block(F.col("key"), bits).alias("block"), "key").repartition("block")
    built = hashed.select("block", F.explode(F.array(*_places(F.col("key")))).alias("bit")).groupBy("block").agg(
        F.expr("bitmap_construct_agg(bit)").alias("bitmap")).select(
        "block", "bitmap", F.lit(bits).cast("long").alias("bits"))
    with _LOCK:
        before = spark.conf.get(_FALLBACK)
        spark.conf.set(_FALLBACK, str(BITMAPS_IN_TASK))
        try:
            return _written(built, "key-filter")
        finally:
            spark.conf.set(_FALLBACK, before)


def merged_filters(one: DataFrame, other: DataFrame) -> DataFrame:
    """The filter of both tables' keys; both filters have one size."""
    return one.unionByName(other).groupBy("block", "bits").agg(
        F.expr("bitmap_or_agg(bitmap)").alias("bitmap")).select("block", "bitmap", "bits")


def _known(rows: DataFrame, keys: Sequence[str], table: DataFrame, bits: int) -> DataFrame:
    """Distinct keys of ``rows`` that the filter ``table`` may hold."""
    asked = rows.select(*keys).distinct().withColumn("__key", F.xxhash64(*keys)).withColumn(
        "__block", _block(F.col("__key"), bits))
    held = table.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap"))
    found = asked.join(held, "__block")
    for place in _places(F.col("__key")):
        byte = F.conv(F.hex(F.substring("__bitmap", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        found = found.where(F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1)
    return found.select(*keys)


def possible_keys(rows: DataFrame, keys: Sequence[str], table: DataFrame) -> DataFrame:
    """Distinct keys of ``rows`` that the filtered table may hold: all that it
    holds, and a few others. Keys with a null are never held."""
    size = table.agg(F.max("bits")).first()[0]
    complete = rows
    for k in keys:
        complete = complete.where(F.col(k).isNotNull())
    return complete.select(*keys).limit(0) if size is None else _known(complete, keys, table, size)


def pk_violations_of_increment(new: DataFrame, keys: Sequence[str], old_filter: DataFrame,
                               old_rows: Callable[[DataFrame], DataFrame],
                               count_name: str = "n_rows") -> DataFrame:
    """DQ-1 on the union of an old table without violations and new rows,
    from the new rows and the old table's filter. ``old_rows`` gets the keys in
    question and returns the old rows that may hold them (all buckets of a
    snapshot that these keys fall into); it is not called when there are none."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    counts = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("__new"))
    asked = _written(possible_keys(new, keys, old_filter), "asked-keys")
    if asked.isEmpty():
        both = counts.withColumn("__old", F.lit(0).cast("long"))
    else:
        old = old_rows(asked).join(asked, list(keys), "left_semi").groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__old"))
        both = counts.join(old, list(keys), "left")
    total = F.col("__new") + F.coalesce("__old", F.lit(0))
    return both.select(*keys, total.alias(count_name)).where((F.col(count_name) > 1) | any_null)


def fk_orphans_of_increment(new: DataFrame, fk: str, dim_filter: DataFrame, pk: str,
                            dim_rows: Callable[[DataFrame], DataFrame],
                            columns: Sequence[str] | None = None) -> DataFrame:
    """DQ-2 on new rows: a key that misses the dimension's filter has no row
    there for certain; the others are looked up in the dimension rows that
    ``dim_rows`` returns for them."""
    rows = new.where(F.col(fk).isNotNull())
    asked = _written(possible_keys(rows.select(F.col(fk).alias(pk)), [pk], dim_filter), "asked-keys")
    if asked.isEmpty():
        out = rows
    else:
        there = dim_rows(asked).join(asked, pk, "left_semi").select(F.col(pk).alias("__k")).distinct()
        out = rows.join(there, F.col(fk) == F.col("__k"), "left_anti")
    return out if columns is None else out.select(*columns)
