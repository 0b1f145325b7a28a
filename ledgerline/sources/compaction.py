"""Landed pulls merged into versioned, bucketed snapshots (MRG-1).

Pulls overlap (``modified >= ds``), so a row can be landed several times and a
changed row lands again. A compaction takes the pulls that no version has taken
yet, keeps the newest version of each of their keys, and merges those into the
buckets of the table that hold their keys. All other buckets keep their files.

A table is dealt into buckets by the hash of its key; their number is set by its
first compaction. A run writes the buckets it touches to a folder of its own and
then a manifest: for each bucket of the table the run whose files hold it. After
both, and the list of pulls it took, one row is added to the table's list of
versions. Readers take the newest version of that list and read the folders its
manifest names, so they never see a half-written table, and a failed run leaves
the old one. Of two runs that start from one version one is kept; pulls that only
the other one took are taken again by the next.

A pull is a folder with the commit marker of its write; without one it is not
ready. It is known by its place and the marker's time, so a folder that was
written again is taken again, whatever the times of its files, and the driver
lists folders, never all landed files.

A version's rows keep their landing time, their ``ds`` and whether they are gone
from the source in columns that readers do not see, so a pull found late neither
beats a row landed after it nor brings a deleted row back. A null key is one key.

``changed_rows`` compares two versions bucket by bucket, reading only buckets
whose files differ: the rows of keys that changed, before and after.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.aggregates import latest_per_key
from ..session import file_system, read_if_there
from .extract import SOURCE_TABLES, laid_out, safe_table_name, write_parquet

#: Rows that a new table gets per bucket, and the most buckets it gets.
BUCKET_ROWS = 2_000_000
MAX_BUCKETS = 8192

_VERSIONS = ("version long, upto timestamp, row_count long, buckets int, run string, parent string, "
             "schema string")
_TAKEN = "ds string, marked long"
_MANIFEST = "bucket int, run string, row_count long"
_BUCKET = "__bucket"
_LANDING = ("__landed", "__ds", "__gone")     # hidden columns of a version


class Pull(NamedTuple):
    """A landed folder and the time of its commit marker."""

    ds: str
    marked: int
    path: str


def _at(snapshot_dir: str, kind: str, table: str, run: str | None = None) -> str:
    base = f"{snapshot_dir.rstrip('/')}/{kind}/{table}"
    return base if run is None else f"{base}/run={run}"


# ---------------------------------------------------------------------------
# Versions
# ---------------------------------------------------------------------------

def _history(spark: SparkSession, snapshot_dir: str, table: str) -> list[Row]:
    """Complete versions that lead to the newest one, newest first: one row per
    compaction of the table."""
    known = read_if_there(spark, _at(snapshot_dir, "_versions", table), _VERSIONS).collect()
    if any(r.run is None for r in known):
        raise ValueError(f"the snapshot of {table} in {snapshot_dir} was written before pulls were "
                         "listed; compact into a new folder")
    by_run = {r.run: r for r in known}
    chain: list[Row] = []
    at = min(known, key=lambda r: (-r.version, r.run), default=None)
    while at is not None:
        chain.append(at)
        at = by_run.get(at.parent)
    return chain


def current_version(spark: SparkSession, snapshot_dir: str, table: str, version: int | None = None):
    """The newest complete version, or the one asked for; None without any."""
    return next((r for r in _history(spark, snapshot_dir, table)
                 if version in (None, r.version)), None)


def manifest(spark: SparkSession, snapshot_dir: str, table: str, version: Row) -> dict[int, str]:
    """Bucket -> run whose files hold it; at most ``MAX_BUCKETS``."""
    rows = spark.read.schema(_MANIFEST).parquet(_at(snapshot_dir, "_manifest", table, version.run))
    return {r.bucket: r.run for r in rows.collect()}


def _bucket_rows(spark: SparkSession, snapshot_dir: str, table: str, version: Row,
                 buckets: Mapping[int, str]) -> DataFrame:
    """Rows of some buckets, hidden columns included."""
    schema = StructType.fromJson(_json(version.schema))
    if not buckets:
        return spark.createDataFrame([], schema)
    base = _at(snapshot_dir, "data", table)
    paths = [f"{base}/run={run}/{_BUCKET}={b}" for b, run in sorted(buckets.items())]
    return spark.read.schema(schema).parquet(*paths).select(*schema.names)


def _json(text: str):
    import json
    return json.loads(text)


def read_snapshot(spark: SparkSession, snapshot_dir: str, table: str,
                  version: int | None = None) -> DataFrame:
    """The table's newest complete version, or an older one."""
    now = current_version(spark, snapshot_dir, table, version)
    if now is None:
        raise ValueError(f"no snapshot of {table} in {snapshot_dir}")
    rows = _bucket_rows(spark, snapshot_dir, table, now, manifest(spark, snapshot_dir, table, now))
    return _visible(rows)


def rows_of_keys(spark: SparkSession, snapshot_dir: str, table: str, keys: DataFrame,
                 key: str = "name") -> DataFrame:
    """Rows of the newest version in the buckets that hold ``keys``; other
    buckets are not read."""
    now = current_version(spark, snapshot_dir, table)
    asked = {r[0] for r in keys.select(bucket_of(key, now.buckets)).distinct().collect()}
    held = manifest(spark, snapshot_dir, table, now)
    return _visible(_bucket_rows(spark, snapshot_dir, table, now,
                                 {b: run for b, run in held.items() if b in asked}))


def _visible(rows: DataFrame) -> DataFrame:
    return rows.where(~F.coalesce("__gone", F.lit(False))).drop(*_LANDING)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


# ---------------------------------------------------------------------------
# Landed pulls
# ---------------------------------------------------------------------------

def landed_since(spark: SparkSession, path: str, upto=None) -> DataFrame:
    """Rows of the pulls under ``path`` landed after ``upto``, with their
    landing time; older files are skipped by their modification time."""
    landed = F.col("_metadata.file_modification_time")
    rows = spark.read.parquet(path).select("*", landed.alias("__landed"))
    return rows if upto is None else rows.where(landed > F.lit(upto))


def landed_pulls(spark: SparkSession, path: str) -> list[Pull]:
    """Complete pulls (``ds=`` folders with a commit marker) of one table."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        _, marker = file_system(spark, f"{status.getPath().toString()}/_SUCCESS")
        if status.isDirectory() and name.startswith("ds=") and fs.exists(marker):
            out.append(Pull(name[3:], fs.getFileStatus(marker).getModificationTime(),
                            f"{path.rstrip('/')}/{name}"))
    return sorted(out)


def pulls_not_taken(spark: SparkSession, path: str, snapshot_dir: str, table: str,
                    history: Sequence[Row]) -> list[Pull]:
    """Pulls under ``path`` that no version of ``history`` has taken."""
    runs = {r.run for r in history}
    listed = read_if_there(spark, _at(snapshot_dir, "_taken", table), _TAKEN + ", run string")
    taken = {(r.ds, r.marked) for r in listed.collect() if r.run in runs}
    return [p for p in landed_pulls(spark, path) if (p.ds, p.marked) not in taken]


def pull_rows(spark: SparkSession, path: str, pulls: Sequence[Pull]) -> DataFrame:
    """Rows of some pulls with their landing time; other folders are not read."""
    return spark.read.option("basePath", path).parquet(*[p.path for p in pulls]).select(
        "*", F.col("_metadata.file_modification_time").alias("__landed"))


def files_not_taken(spark: SparkSession, path: str, snapshot_dir: str, table: str, now
                    ) -> tuple[DataFrame, list[str]]:
    """(rows with their landing time, files) of the pulls that no version up to
    ``now`` has taken. Files are named by their place in the table's folder."""
    history = [r for r in _history(spark, snapshot_dir, table)
               if now is not None and r.version <= now.version]
    pulls = pulls_not_taken(spark, path, snapshot_dir, table, history)
    if not pulls:
        return landed_since(spark, path).limit(0), []
    rows = pull_rows(spark, path, pulls)
    folder = f"/{path.rsplit('/', 1)[-1]}/"
    return rows, [f.rsplit(folder, 1)[-1] for f in rows.inputFiles()]


# ---------------------------------------------------------------------------
# Merging
# ---------------------------------------------------------------------------

def newest_rows(pulls: DataFrame, key: str, modified: str) -> DataFrame:
    """Newest row of every key of some pulls, with its landing: later
    ``modified`` first, then the later landing, then the later ``ds``. A row
    without ``modified`` is older than any with one, one without a landing than
    any pull."""
    rows = pulls.withColumn("__ds", F.col("ds").cast("string")).drop("ds")
    if "__gone" not in rows.columns:
        rows = rows.withColumn("__gone", F.lit(False))
    return latest_per_key(rows, [key], [modified, *_LANDING])


def _aligned(frame: DataFrame, schema: StructType) -> DataFrame:
    """``frame`` with the columns of ``schema``; null where it has none."""
    return frame.select(*[(F.col(f"`{f.name}`") if f.name in frame.columns else F.lit(None))
                          .cast(f.dataType).alias(f.name) for f in schema.fields])


def merge_newest(old: DataFrame, new: DataFrame, key: str, modified: str) -> DataFrame:
    """The newer of the old and the new row of every key; both hold each key
    once. One join: the rows of a key are compared as structs, in the order of
    ``newest_rows``."""
    schema = old.limit(0).unionByName(new.limit(0), allowMissingColumns=True).schema
    order = [modified, *_LANDING]
    rest = [c for c in schema.names if c != key and c not in order]

    def packed(frame: DataFrame, name: str) -> DataFrame:
        fields = [F.col(f"`{c}`") for c in (*order, *rest)]
        return _aligned(frame, schema).select(F.col(f"`{key}`").alias(f"{name}_key"),
                                              F.struct(*fields).alias(name))
    both = packed(old, "__old").join(packed(new, "__new"),
                                     F.expr("__old_key <=> __new_key"), "full_outer")
    return both.select(F.coalesce("__old_key", "__new_key").alias(key),
                       F.greatest("__old", "__new").alias("__row")).select(
        *[F.col(f"`{c}`") if c == key else F.col(f"__row.`{c}`").alias(c) for c in schema.names])


def _write_run(spark: SparkSession, snapshot_dir: str, table: str, rows: DataFrame, key: str,
               buckets: int, kept: Mapping[int, str], now: Row | None, upto,
               pulls: Sequence[Pull], layout: tuple[str, Sequence[str]] | None) -> int:
    """Writes the buckets of ``rows`` and the manifest that adds them to
    ``kept``, then the version; returns the table's rows."""
    run = uuid.uuid4().hex
    data = _at(snapshot_dir, "data", table, run)
    _, order = laid_out(rows.limit(0), layout)
    schema = rows.schema
    dealt = rows.withColumn(_BUCKET, bucket_of(key, buckets)).hint("rebalance", _BUCKET)
    write_parquet(dealt, data, sort_within=[_BUCKET, *order], partition_by=[_BUCKET])
    written = spark.read.schema(StructType([*schema.fields]).add(_BUCKET, "integer")).parquet(data)
    counts = written.groupBy(_BUCKET).agg(
        F.count(F.when(~F.coalesce("__gone", F.lit(False)), 1)).alias("n")).collect()
    before = {}
    if kept:
        listed = spark.read.schema(_MANIFEST).parquet(_at(snapshot_dir, "_manifest", table, now.run))
        before = {r.bucket: r.row_count for r in listed.collect()}
    entries = [(b, kept[b], before[b]) for b in kept] + [(r[_BUCKET], run, r.n) for r in counts]
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.parquet(
        _at(snapshot_dir, "_manifest", table, run))
    spark.createDataFrame([(p.ds, p.marked) for p in pulls], _TAKEN).coalesce(1).write.parquet(
        _at(snapshot_dir, "_taken", table, run))
    total = sum(n for _, _, n in entries)
    version = (0 if now is None else now.version + 1, upto, total, buckets, run,
               now.run if now is not None else None, schema.json())
    spark.createDataFrame([version], _VERSIONS).coalesce(1).write.mode("append").parquet(
        _at(snapshot_dir, "_versions", table))
    return total


def compact_table(spark: SparkSession, landing_dir: str, snapshot_dir: str, table: str,
                  source_table: str, key: str = "name", modified: str = "modified",
                  layout: tuple[str, Sequence[str]] | None = None,
                  bucket_rows: int = BUCKET_ROWS) -> int:
    """Writes the next version of one table; returns its rows.

    A table without ``modified`` is replaced by its last landed pull. Without
    new pulls nothing is written. Rows deleted in the source are not seen by
    incremental pulls (see ``deletions``).
    """
    path = f"{landing_dir.rstrip('/')}/{safe_table_name(source_table)}"
    history = _history(spark, snapshot_dir, table)
    now = history[0] if history else None
    pulls = pulls_not_taken(spark, path, snapshot_dir, table, history)
    if not pulls:
        if now is None:
            raise ValueError(f"no complete pull in {path}")
        return now.row_count
    rows = pull_rows(spark, path, pulls)
    upto = rows.agg(F.max("__landed")).first()[0]
    later = now is not None and now.upto is not None and (upto is None or upto < now.upto)
    if modified not in rows.columns:
        if later:       # the version is of a pull landed after these
            return now.row_count
        last = rows.agg(F.max(F.struct("__landed", F.col("ds").cast("string").alias("ds")))
                        .alias("m")).select("m.ds").scalar()
        rows = rows.where(F.col("ds").cast("string") == last) if upto is not None else rows
        newest = rows.withColumns({"__ds": F.col("ds").cast("string"), "__gone": F.lit(False)}).drop("ds")
        n = _buckets(newest.count(), bucket_rows) if now is None else now.buckets
        return _write_run(spark, snapshot_dir, table, newest, key, n, {}, now, upto, pulls, layout)
    upto = now.upto if later else upto
    newest = newest_rows(rows, key, modified)
    return merge_rows(spark, snapshot_dir, table, newest, key, modified, now, upto, pulls, layout,
                      bucket_rows)


def merge_rows(spark: SparkSession, snapshot_dir: str, table: str, newest: DataFrame, key: str,
               modified: str, now: Row | None, upto, pulls: Sequence[Pull] = (),
               layout: tuple[str, Sequence[str]] | None = None,
               bucket_rows: int = BUCKET_ROWS) -> int:
    """Merges rows (one per key, with their landing) into the version ``now``
    and writes the next one: only buckets that hold their keys are read and
    written."""
    staged = f"{_at(snapshot_dir, '_staged', table)}/run={uuid.uuid4().hex}"
    schema = newest.schema
    rows = write_parquet(newest, staged)
    newest = spark.read.schema(schema).parquet(staged)
    if now is None:
        return _write_run(spark, snapshot_dir, table, newest, key, _buckets(rows, bucket_rows), {},
                          None, upto, pulls, layout)
    held = manifest(spark, snapshot_dir, table, now)
    touched = {r[0] for r in newest.select(bucket_of(key, now.buckets)).distinct().collect()}
    old = _bucket_rows(spark, snapshot_dir, table, now,
                       {b: run for b, run in held.items() if b in touched})
    return _write_run(spark, snapshot_dir, table, merge_newest(old, newest, key, modified), key,
                      now.buckets, {b: run for b, run in held.items() if b not in touched}, now,
                      upto, pulls, layout)


def _buckets(rows: int, bucket_rows: int) -> int:
    return max(1, min(MAX_BUCKETS, -(-rows // bucket_rows)))


def compact_landing(spark: SparkSession, landing_dir: str, snapshot_dir: str,
                    tables: Mapping[str, str] | None = None, key: str = "name",
                    modified: str = "modified",
                    layout: Mapping[str, tuple[str, Sequence[str]]] | None = None,
                    bucket_rows: int = BUCKET_ROWS) -> dict[str, int]:
    """Compacts every landed table; ``SnapshotTables`` reads the result."""
    return {table: compact_table(spark, landing_dir, snapshot_dir, table, source, key, modified,
                                 (layout or {}).get(table), bucket_rows)
            for table, source in (tables or SOURCE_TABLES).items()}


# ---------------------------------------------------------------------------
# Changes between versions
# ---------------------------------------------------------------------------

def changed_rows(spark: SparkSession, snapshot_dir: str, table: str, since: int | None,
                 until: int | None = None, key: str = "name") -> DataFrame:
    """(key, before, after) of the keys whose row differs between two versions;
    a missing row is null. ``since=None`` stands for the empty table. Buckets
    that both versions take from the same files are not read. A null key is a
    key like any other."""
    new = current_version(spark, snapshot_dir, table, until)
    old = current_version(spark, snapshot_dir, table, since) if since is not None else None
    if new is None or (since is not None and old is None):
        raise ValueError(f"no such version of {table} in {snapshot_dir}")
    held = {v.run: manifest(spark, snapshot_dir, table, v) for v in (old, new) if v is not None}
    is_of = lambda v, other: {b: run for b, run in held[v.run].items()
                              if other is None or held[other.run].get(b) != run}
    after = _visible(_bucket_rows(spark, snapshot_dir, table, new, is_of(new, old)))
    before = (after.limit(0) if old is None
              else _visible(_bucket_rows(spark, snapshot_dir, table, old, is_of(old, new))))
    schema = before.limit(0).unionByName(after.limit(0), allowMissingColumns=True).schema

    def packed(frame: DataFrame, name: str) -> DataFrame:
        return _aligned(frame, schema).select(
            F.col(f"`{key}`").alias(f"{name}_key"),
            F.struct(*[F.col(f"`{c}`") for c in schema.names]).alias(name))
    both = packed(before, "before").join(packed(after, "after"),
                                         F.expr("before_key <=> after_key"), "full_outer")
    return both.where(F.expr("NOT (before <=> after)")).select(
        F.coalesce("before_key", "after_key").alias(key), "before", "after")


class SnapshotTables:
    """ERP tables read from the newest complete versions of a snapshot folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCE_TABLES:
            raise AttributeError(name)
        df = read_snapshot(self.spark, self.root, name)
        self.__dict__[name] = df
        return df
