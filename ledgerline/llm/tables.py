"""Helpers for intermediate tables and joins with a small side."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A side of at most so many rows (of a few short columns) may be broadcast.
BROADCAST_ROWS = 200_000
SALTS = 64
#: Settings of a write of an intermediate table: its shuffle files go with it,
#: and Arrow batches stay small beside an executor's memory.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
_LOCK = threading.RLock()


@contextmanager
def _write_settings(spark: SparkSession) -> Iterator[None]:
    """The session's settings for one write; one write at a time, so that none
    takes another's settings for the session's own."""
    with _LOCK:
        before = {k: spark.conf.get(k) for k in WRITE_CONF}
        for k, v in WRITE_CONF.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Writes ``frame`` to the shared folder and reads it back: lineage ends
    there, and a lost executor costs no more than the tasks it ran. The shuffle
    files of the write are dropped with it."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    with _write_settings(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_side(frame: DataFrame) -> DataFrame:
    """``frame``, a stored table, as a join side: counted, and broadcast up to
    ``BROADCAST_ROWS`` rows; beyond that the join shuffles."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def join_small(large: DataFrame, small: DataFrame, on: list[str], salt_by: str,
               how: str = "inner", rows: int | None = None) -> DataFrame:
    """Joins a table with one that is expected to be small.

    ``small`` is counted; up to ``BROADCAST_ROWS`` rows it is broadcast, beyond
    that both sides are shuffled with the keys salted by ``salt_by`` (a column
    of ``large``), so a hot key is spread over ``SALTS`` tasks."""
    rows = small.count() if rows is None else rows
    if rows <= BROADCAST_ROWS:
        return large.join(F.broadcast(small), on, how)
    salted = large.withColumn("__salt", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")
