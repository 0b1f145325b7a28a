"""Incremental landing with Structured Streaming (SRC-4 + MRG-1).

The source pulls a table with ``modified >= ds`` (a lower bound only), so
consecutive pulls overlap and the same row arrives more than once, changed or
not. Here the pulls are Parquet files dropped into a folder
(``sources.extract.extract_to_landing``) and a streaming query turns them into
one append-only history:

* a file source reads each new pull once (its offsets are in the checkpoint,
  so a restarted job continues where it stopped), a bounded number of files
  per micro-batch;
* every row is kept, with the ``ds`` of its pull: which version of a key is
  the newest is decided by the merge, because a row can change without its
  ``modified`` changing. The query has no state;
* the Parquet sink commits each micro-batch exactly once through its metadata
  log, so readers never see a half-written batch.

``current_rows`` reads the current state of the table: the newest version per
key, by ``modified`` and then by pull. ``sources.compaction`` keeps snapshots
from which old pulls need not be read again.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from ..operators.aggregates import latest_per_key
from ..session import scratch_path


def stream_increments(spark: SparkSession, source_dir: str, schema: StructType, target_dir: str,
                      checkpoint_dir: str | None = None, available_now: bool = True,
                      processing_time: str = "1 minute",
                      max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start the stream from landed pulls (``ds=<pull>`` folders) to the
    append-only history.

    With ``available_now`` the query processes what is there and stops (a
    scheduled batch run); otherwise it polls every ``processing_time``.
    The checkpoint lives under the shared folder unless given.
    """
    checkpoint = checkpoint_dir or scratch_path(spark, "increments-checkpoint")
    pulls = (spark.readStream.schema(StructType([*schema.fields]).add("ds", StringType()))
             .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    writer = (pulls.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .outputMode("append"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start(target_dir)


def current_rows(spark: SparkSession, target_dir: str, keys: Sequence[str],
                 modified: str = "modified") -> DataFrame:
    """The newest version of every key in the landed history."""
    return latest_per_key(spark.read.parquet(target_dir), keys, [modified, "ds"]).drop("ds")


def pull_to_folder(df: DataFrame, folder: str, ds: str) -> str:
    """Drop one pull into the stream's source folder (``ds=<ds>`` subfolder)."""
    path = f"{folder.rstrip('/')}/ds={ds}"
    df.write.mode("overwrite").parquet(path)
    return path


def with_modified(df: DataFrame, column: str, name: str = "modified") -> DataFrame:
    """Use a date/timestamp column of a pull as its ``modified`` timestamp."""
    return df.withColumn(name, F.col(column).cast("timestamp"))
