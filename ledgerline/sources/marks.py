"""Increments that know where the last one ended (SRC-4).

A pull reads what changed since the mark of earlier pulls, lands it, and only
then writes its own mark: the largest ``modified`` that its write saw and the
time it began. The next pull starts at the smaller of the two, less an overlap.
So

* a run that dies between landing and mark costs a second reading, no row: the
  next pull starts where the one before began;
* a ``modified`` in the future (a wrong clock, a typing error) does not move the
  mark beyond the time of the pull;
* a transaction that commits late, with a ``modified`` before the mark, is read
  as long as it is late by less than the overlap;
* a pull that is run again under its name starts where its first run started,
  since it replaces that run's folder.

Rows without ``modified`` are in every pull. What is read twice is merged by
``compaction``. Marks are rows of a Parquet table beside the landed tables,
added by Spark's commit protocol.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import read_if_there
from .extract import (SPLIT_COLUMN, JdbcSource, ParquetSource, landing_path, quote_table, read_table,
                      safe_table_name, sql_literal, write_parquet)

OVERLAP = dt.timedelta(hours=1)

_MARKS = ("ds string, began timestamp_ntz, bound timestamp_ntz, seen timestamp_ntz, row_count long")


class Landed(NamedTuple):
    path: str
    rows: int
    bound: dt.datetime | None
    seen: dt.datetime | None


def _marks_path(landing_dir: str, table: str) -> str:
    return f"{landing_dir.rstrip('/')}/_marks/{safe_table_name(table)}"


def marks(spark: SparkSession, landing_dir: str, table: str):
    """One row per finished pull of a table."""
    return read_if_there(spark, _marks_path(landing_dir, table), _MARKS)


def next_bound(spark: SparkSession, landing_dir: str, table: str, ds: str,
               overlap: dt.timedelta = OVERLAP) -> dt.datetime | None:
    """Where the pull ``ds`` starts; None when all rows are to be read.

    The newest mark counts, whichever pull wrote it: one that saw no rows does
    not move it. A pull that has a mark already starts where it started."""
    known = marks(spark, landing_dir, table)
    again = known.where(F.col("ds") == ds).orderBy("began").first()
    if again is not None:
        return again.bound
    mark = known.agg(F.max(F.least("seen", F.when(F.col("seen").isNotNull(), F.col("began"))))).first()[0]
    return None if mark is None else mark - overlap


def pull_increment(spark: SparkSession, source: JdbcSource | ParquetSource, table: str,
                   landing_dir: str, ds: str, column: str = SPLIT_COLUMN,
                   overlap: dt.timedelta = OVERLAP, began: dt.datetime | None = None,
                   compression: str = "snappy", **read_options) -> Landed:
    """Lands the rows of ``table`` changed since its mark under ``ds`` and marks
    the pull. ``ds`` names the pull: give every one its own, since a folder is
    replaced by a pull of the same name."""
    began = began or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    bound = next_bound(spark, landing_dir, table, ds, overlap)
    name = quote_table(column)
    where = None if bound is None else f"{name} >= {sql_literal(bound)} OR {name} IS NULL"
    if bound is not None and not {"predicates", "splits", "partition_column"} & set(read_options):
        read_options = {"split_from": bound.date().isoformat(), "split_column": column, **read_options}
    rows = read_table(spark, source, table, where=where, **read_options)
    path = landing_path(landing_dir, table, ds)
    written = write_parquet(rows, path, compression=compression,
                            also={"seen": F.max(F.col(name).cast("timestamp_ntz"))})
    seen = written["seen"]
    spark.createDataFrame([(ds, began, bound, seen, written["rows"])], _MARKS).coalesce(1).write.mode(
        "append").parquet(_marks_path(landing_dir, table))
    return Landed(path, written["rows"], bound, seen)
