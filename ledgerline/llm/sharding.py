"""Sharding through fixed virtual slots.

A record's slot is a hash of its key modulo a fixed number of slots
(thousands); the slot never changes. Bytes are summed per slot, and a
versioned slot-to-shard map, stored as Parquet, says where each slot lives.
Version 0 deals slots round robin; rebalancing writes the next version, in
which only the slots that overfill a shard move. The map has ``n_slots``
rows whatever the size of the corpus, so it is the one thing that is folded
into a single row or broadcast.

Law of the query: ``bytes`` - shard sizes are near equal.

Defined cases: null texts weigh the overhead only and have the checksum of
no bytes (0); empty texts likewise; repeated keys and equal texts are placed
row by row (equal keys share a slot, whose rows are numbered in ``PARTS`` parts,
equal rows of a part counted before they are); a null key has the slot of null's
hash; an empty table gives an empty result and a round-robin map; only the key and
text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import stored as stored_table

N_SLOTS = 8192
N_SHARDS = 40
ROW_OVERHEAD = 16
#: A slot's rows are numbered in so many parts, equal rows of one key counted in
#: so many salts: a key that holds much of the table is many tasks' work.
PARTS, SALTS = 16, 64


def slot_of(key: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


def record_size(text: Column, overhead: int = ROW_OVERHEAD) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long")


def initial_map(spark: SparkSession, n_slots: int, n_shards: int) -> DataFrame:
    """Version 0: slots dealt round robin."""
    return spark.range(n_slots).select(
        F.col("id").cast("int").alias("vslot"), (F.col("id") % n_shards).cast("int").alias("shard"),
        F.lit(0).alias("version"))


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and rows of each slot, summed before the shuffle."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"),
                                        F.count(F.lit(1)).alias("rows"))


def rebalanced_map(current: DataFrame, weights: DataFrame, n_shards: int) -> DataFrame:
    """The next version: each shard keeps its largest slots up to the mean
    load; slots beyond it are released and go, largest first, to the shard
    that is lightest by then. ``n_shards`` may differ from the old map's.

    Windows and the fold see one row per slot, a fixed number.
    """
    slots = (current.join(weights.select("vslot", "bytes"), "vslot", "left")
             .select("vslot", "shard", "version",
                     F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")))
    goal = slots.agg((F.sum("bytes") / n_shards).alias("goal"))
    by_shard = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    ranked = slots.select("*", F.sum("bytes").over(
        by_shard.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    marked = ranked.select("vslot", "shard", "version", "bytes",
                           (((F.col("upto") <= goal.scalar()) | (F.col("bytes") == 0))
                            & (F.col("shard") < n_shards)).alias("stays"))
    # One row: the kept load of each shard and the released slots in order.
    folded = marked.agg(
        F.collect_list(F.when(~F.col("stays"), F.struct(
            (-F.col("bytes")).alias("minus"), F.col("vslot")))).alias("released"),
        *[F.coalesce(F.sum(F.when(F.col("stays") & (F.col("shard") == i), F.col("bytes"))),
                     F.lit(0)).alias(f"load_{i}") for i in range(n_shards)])

    def place(state: Column, slot: Column) -> Column:
        # loads are (load, shard) pairs, so the minimum is the lightest shard
        lightest = F.array_min(state["loads"])
        loads = F.transform(state["loads"], lambda x: F.when(
            x["shard"] == lightest["shard"],
            F.struct((x["load"] - slot["minus"]).alias("load"), x["shard"].alias("shard")))
            .otherwise(x))
        return F.struct(loads.alias("loads"), F.concat(
            state["placed"], F.array(F.struct(slot["vslot"].alias("vslot"),
                                              lightest["shard"].alias("to")))).alias("placed"))

    start = F.struct(
        F.array(*[F.struct(F.col(f"load_{i}").alias("load"), F.lit(i).alias("shard"))
                  for i in range(n_shards)]).alias("loads"),
        F.array().cast("array<struct<vslot:int,to:int>>").alias("placed"))
    moves = folded.select(F.inline(F.aggregate(
        F.sort_array("released"), start, place, lambda s: s["placed"])))
    return marked.join(F.broadcast(moves), "vslot", "left").select(
        "vslot", F.coalesce("to", "shard").cast("int").alias("shard"),
        (F.col("version") + 1).alias("version"), "bytes")


def store_map(slot_map: DataFrame, path: str) -> DataFrame:
    """Adds the map's version to the store under ``path`` and returns it. A
    version is written once: of two runs that edit the same map the later one
    fails (PATH_ALREADY_EXISTS) and replaces nothing. A folder without
    ``_SUCCESS`` is what a broken run left, and has to be removed."""
    spark = slot_map.sparkSession
    version = slot_map.agg(F.max("version")).first()[0]
    target = f"{path.rstrip('/')}/version={version}"
    slot_map.drop("version").coalesce(1).write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target).withColumn("version", F.lit(version))


def newest_map(spark: SparkSession, path: str, n_slots: int, n_shards: int) -> DataFrame:
    """The newest stored version; version 0 is stored first where there is none."""
    try:
        newest = spark.read.schema("vslot int, shard int, version int").parquet(path).agg(
            F.max("version")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        return store_map(initial_map(spark, n_slots, n_shards), path)
    stored = spark.read.parquet(f"{path.rstrip('/')}/version={newest}").select(
        "vslot", "shard", F.lit(newest).alias("version"))
    if stored.count() != n_slots:
        raise ValueError(f"the map in {path} is not one of {n_slots} slots")
    return stored


def records_of(documents: DataFrame, key: str = "doc_id", text: str = "text",
               n_slots: int = N_SLOTS) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        F.col(key).alias("doc_id"), record_size(F.col(text)).alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        slot_of(F.col(key), n_slots).alias("vslot"))


def shard_documents(documents: DataFrame, map_path: str, n_shards: int = N_SHARDS,
                    n_slots: int = N_SLOTS, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Every record with its size, checksum, virtual slot, shard and its place
    in the shard (``slot``, gapless from 0).

    The records (four short columns) are stored once; texts are read once.
    Equal rows are counted before the shuffle, counts are summed in order inside
    each part of a virtual slot, and parts are shifted by the rows before them in
    their shard, so no task ever orders a whole shard, nor all rows of a hot key.
    The newest map under ``map_path`` is rebalanced and stored as the next
    version, so a grown corpus moves only slots that overfill a shard.
    """
    records = stored_table(records_of(documents, key, text, n_slots), "shard-records")
    counted = stored_table(
        records.withColumn("part", F.pmod(F.xxhash64("text_crc32", "size"), F.lit(PARTS)).cast("int"))
        .withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        .groupBy("vslot", "part", "doc_id", "text_crc32", "size", "salt")
        .agg(F.count(F.lit(1)).alias("copies")), "shard-counts")
    # n_slots * PARTS rows at most, whatever the size of the corpus
    parts = counted.groupBy("vslot", "part").agg(
        F.sum("copies").alias("rows"), F.sum(F.col("size") * F.col("copies")).alias("bytes"))
    weights = parts.groupBy("vslot").agg(F.sum("bytes").alias("bytes"))
    slot_map = store_map(
        rebalanced_map(newest_map(documents.sparkSession, map_path, n_slots, n_shards), weights,
                       n_shards), map_path)
    earlier = Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (slot_map.select("vslot", "shard", "version").join(parts, "vslot")
               .select("vslot", "part", "shard", "version",
                       F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")))
    inside = Window.partitionBy("vslot", "part").orderBy(
        "doc_id", "text_crc32", "size", "salt").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("before") + F.coalesce(F.col("upto"), F.lit(0))
    return (counted.withColumn("upto", F.sum("copies").over(inside))
            .join(F.broadcast(offsets), ["vslot", "part"])
            .select("doc_id", "size", "text_crc32", "shard",
                    F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("slot"),
                    F.col("vslot").alias("virtual_slot"), F.col("version").alias("map_version")))
