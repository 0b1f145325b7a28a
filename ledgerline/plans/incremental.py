"""Tables kept up to date by what changed (SNK-4, CAT-1).

``refresh_daily_sales`` keeps submitted sales per day, from which the trackers
(RPT-13, RPT-14) are read, by the changes between two versions of the invoice
snapshot: a changed invoice takes its old amount out of its old day and adds the
new one to its new day, a cancelled or deleted one is only taken out. The work
follows the changes, not the history.

``load_dimension`` loads a table of the star schema: rows whose content did not
change are not written and keep both stamps, changed rows get a new
``updated_at`` and keep ``created_at``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import quality
from ..session import read_if_there
from ..sources import compaction
from ..sources.extract import write_parquet

_STATES = "run string, state string, version long"


def _latest_state(spark: SparkSession, state_dir: str, history) -> tuple[str, int] | None:
    """(folder, version) of the newest state that is of a version of ``history``."""
    rows = read_if_there(spark, f"{state_dir.rstrip('/')}/_states", _STATES).collect()
    of_run = {r.run: r.state for r in rows}
    return next(((of_run[v.run], v.version) for v in history if v.run in of_run), None)


def refresh_daily_sales(spark: SparkSession, snapshot_dir: str, state_dir: str,
                        table: str = "sales_invoice", day: str = "posting_date",
                        amount: str = "base_grand_total", counts: Column | None = None,
                        key: str = "name") -> DataFrame:
    """(posting_date, sales_today, n) of all days, as of the newest version of
    the snapshot. ``counts`` is the condition for a row to be counted (submitted
    by default). A refresh that dies leaves the old state."""
    counts = F.col("docstatus") == 1 if counts is None else counts
    history = compaction._history(spark, snapshot_dir, table)
    if not history:
        raise ValueError(f"no snapshot of {table} in {snapshot_dir}")
    known = _latest_state(spark, state_dir, history)
    now = history[0]
    if known is not None and known[1] == now.version:
        return spark.read.parquet(known[0])
    changes = compaction.changed_rows(spark, snapshot_dir, table, known and known[1], now.version, key)

    def side(name: str, sign: int) -> DataFrame:
        rows = changes.where(F.col(name).isNotNull()).select(f"{name}.*").where(counts)
        return rows.select(F.col(day).alias("posting_date"), (F.col(amount) * sign).alias("sales_today"),
                           F.lit(sign).cast("long").alias("n"))

    moved = side("after", 1).unionByName(side("before", -1)).groupBy("posting_date").agg(
        F.sum("sales_today").alias("sales_today"), F.sum("n").alias("n"))
    if known is not None:
        moved = moved.unionByName(spark.read.parquet(known[0])).groupBy("posting_date").agg(
            F.sum("sales_today").alias("sales_today"), F.sum("n").alias("n"))
    path = f"{state_dir.rstrip('/')}/state={uuid.uuid4().hex}"
    kind = changes.schema["after"].dataType[amount].dataType
    total = F.col("sales_today").cast(f"decimal(38,{kind.scale})" if hasattr(kind, "scale") else "double")
    write_parquet(moved.where(F.col("n") != 0).select("posting_date", total.alias("sales_today"), "n"), path)
    spark.createDataFrame([(now.run, path, now.version)], _STATES).coalesce(1).write.mode("append").parquet(
        f"{state_dir.rstrip('/')}/_states")
    return spark.read.parquet(path)


def row_digest(columns: Sequence[str]) -> Column:
    """Digest of some columns; nulls are told from empty texts."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]),
                            {"ignoreNullFields": "false"}), 256)


def load_dimension(spark: SparkSession, name: str, rows: DataFrame, snapshot_dir: str,
                   load_time: dt.datetime) -> int:
    """Loads ``rows`` into the dimension ``name``; returns the rows written.

    The dimension is a bucketed snapshot: only buckets with new or changed rows
    are written. Rows that ``rows`` does not have stay. A repeated or null key
    is refused, as the table's primary key says. An earlier load that is run
    late does not replace what a later one wrote."""
    schema, (key,) = schemas.TABLES[name], schemas.KEYS[name]
    stamps = ("created_at", "updated_at")
    columns = [f.name for f in schema.fields if f.name not in stamps]
    wanted = {f.name: f.dataType for f in schema.fields}
    incoming = schemas.with_defaults(name, rows.select(*[c for c in columns if c in rows.columns]))
    incoming = incoming.select(*[(F.col(c) if c in incoming.columns else F.lit(None))
                                 .cast(wanted[c]).alias(c) for c in columns])
    if not quality.pk_violations(incoming, [key]).isEmpty():
        raise ValueError(f"{name}: {key} is repeated or null")
    stamp = F.lit(load_time).cast("timestamp")
    now = compaction.current_version(spark, snapshot_dir, name)
    content = [c for c in columns if c != key]
    fresh = incoming.withColumn("__digest", row_digest(content))
    if now is None:
        changed = fresh.withColumn("created_at", stamp)
    else:
        old = compaction.read_snapshot(spark, snapshot_dir, name).select(
            F.col(key), row_digest(content).alias("__was"), F.col("created_at"))
        # merged by key: as a broadcast the old digests would all pass through the driver
        changed = fresh.join(old.hint("merge"), key, "left").where(~F.col("__digest").eqNullSafe(F.col("__was"))).withColumn(
            "created_at", F.coalesce("created_at", stamp))
    changed = changed.select(*columns, "created_at", stamp.alias("updated_at"), stamp.alias("__landed"),
                             F.lit("load").alias("__ds"), F.lit(False).alias("__gone"))
    n = changed.count()
    if n:
        upto = now.upto if now is not None else None
        compaction.merge_rows(spark, snapshot_dir, name, changed, key, "updated_at", now, upto)
    return n
