"""Rows deleted in the source (MRG-1).

Incremental pulls never show that a row is gone, and reading all keys of the
source to find out is a full read. Here source and snapshot are compared by
digests of key ranges: number of keys and two sums of their checksums, worked
out on either side where the keys are. Ranges whose digests agree are done;
those that differ are cut into smaller ones and compared again, each level
reading only ranges that still differ. Keys are fetched from small ranges only,
and what the snapshot has and the source has not becomes tombstone rows, which
are merged like any pull: only their buckets are written again. A row that is
pulled again later, with a later ``modified``, is back; so compact what has
landed before comparing.

New rows that no pull has brought yet make ranges differ too; they cost reading,
nothing else. Keys are texts or whole numbers. Both sides have to order keys
alike: for texts by bytes, which the database does with ``binary=True``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .compaction import _bucket_rows, _history, manifest, merge_rows, read_snapshot
from .extract import JdbcSource, quote_table, read_query, sql_literal
from .splits import plan_bounds

FANOUT = 64
LEAF_KEYS = 20_000
#: Most ranges of a table (beyond, they hold more keys), and ranges of a query.
MAX_LEAVES, ARMS = 65_536, 256


def _ordered(key: str, binary: bool) -> str:
    return f"CAST({quote_table(key)} AS BINARY)" if binary else quote_table(key)


def _between(name: str, low, high) -> str:
    """SQL: keys from ``low`` up to ``high``; None is open."""
    parts = [f"{name} >= {sql_literal(low)}"] if low is not None else []
    parts += [f"{name} < {sql_literal(high)}"] if high is not None else []
    return "(" + (" AND ".join(parts) or f"{name} IS NOT NULL") + ")"


def _digest_query(relation: str, key: str, ranges: list[tuple], binary: bool) -> str:
    """Digests of ranges in one query that reads these ranges only."""
    name = _ordered(key, binary)
    arms = " ".join(f"WHEN {_between(name, low, high)} THEN {i}" for i, (low, high) in enumerate(ranges))
    inside = " OR ".join(_between(name, low, high) for low, high in _joined(ranges))
    text = f"CONCAT({quote_table(key)}, '')"
    return (f"SELECT part_, COUNT(*) AS n_, SUM(CRC32({text})) AS s_, "
            f"BIT_XOR(CRC32(CONCAT({text}, '#')) * 65537 + CRC32({text})) AS x_ "
            f"FROM (SELECT {quote_table(key)}, CASE {arms} END AS part_ FROM {relation} "
            f"WHERE {inside}) AS dealt GROUP BY part_")


def _joined(ranges: list[tuple]) -> list[tuple]:
    """Neighbouring ranges put together."""
    out: list[list] = []
    for low, high in ranges:
        if out and out[-1][1] is not None and out[-1][1] == low:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [tuple(x) for x in out]


def _digests(spark: SparkSession, source: JdbcSource | None, relation: str, key: str,
             ranges: list[tuple], binary: bool) -> list[tuple[int, int, int]]:
    """(keys, sum, mixed sum) of each range, ``ARMS`` ranges a query."""
    out = [(0, 0, 0)] * len(ranges)
    for begin in range(0, len(ranges), ARMS):
        query = _digest_query(relation, key, ranges[begin:begin + ARMS], binary)
        for r in read_query(spark, source, query).collect():
            out[begin + r["part_"]] = tuple(int(r[c] or 0) for c in ("n_", "s_", "x_"))
    return out


def differing_ranges(spark: SparkSession, source: JdbcSource | None, relation: str, mine: str,
                     key: str, fanout: int = FANOUT, leaf_keys: int = LEAF_KEYS,
                     binary: bool = False) -> list[tuple]:
    """Key ranges (low, high) of about ``leaf_keys`` keys in which the keys of
    ``relation`` (at the source) and of the view ``mine`` differ, in order."""
    total = read_query(spark, None, f"SELECT COUNT(*) AS n FROM {mine}").first()["n"]
    leaves = max(1, min(MAX_LEAVES, -(-total // leaf_keys)))
    edges = [None, *(b[0] for b in plan_bounds(spark, None, mine, [key], leaves, f"{quote_table(key)} IS NOT NULL")),
             None]
    spans = [(0, len(edges) - 1)]           # of neighbouring leaves
    while True:
        ranges = [(edges[i], edges[j]) for i, j in spans]
        ours = _digests(spark, None, mine, key, ranges, False)
        theirs = _digests(spark, source, relation, key, ranges, binary)
        spans = [s for s, a, b in zip(spans, ours, theirs) if a != b]
        if all(j - i == 1 for i, j in spans):
            return [(edges[i], edges[j]) for i, j in spans]
        spans = [(k, min(k + step, j)) for i, j in spans for step in [-(-(j - i) // fanout)]
                 for k in range(i, j, step)]


def deleted_rows(spark: SparkSession, source: JdbcSource | None, relation: str, snapshot_dir: str,
                 table: str, key: str = "name", binary: bool = False, fanout: int = FANOUT,
                 leaf_keys: int = LEAF_KEYS) -> DataFrame | None:
    """Visible snapshot rows, hidden columns included, whose key the source has
    no longer; None if all ranges agree."""
    now = _history(spark, snapshot_dir, table)[0]
    view = f"snapshot_keys_{uuid.uuid4().hex[:12]}"
    read_snapshot(spark, snapshot_dir, table).select(F.col(f"`{key}`")).createOrReplaceTempView(view)
    try:
        ranges = _joined(differing_ranges(spark, source, relation, view, key, fanout, leaf_keys,
                                          binary))
    finally:
        spark.catalog.dropTempView(view)
    if not ranges:
        return None
    inside = [" OR ".join(_between(name, *r) for r in ranges)
              for name in (quote_table(key), _ordered(key, binary))]
    there = read_query(spark, source, f"SELECT {quote_table(key)} FROM {relation} WHERE {inside[1]}")
    rows = _bucket_rows(spark, snapshot_dir, table, now, manifest(spark, snapshot_dir, table, now))
    return rows.where(f"({inside[0]}) AND NOT coalesce(__gone, false)").join(
        there.select(F.col(f"`{key}`")).distinct(), key, "left_anti").select(*rows.columns)


def drop_deleted(spark: SparkSession, source: JdbcSource | None, relation: str, snapshot_dir: str,
                 table: str, key: str = "name", modified: str = "modified", binary: bool = False,
                 found_at: dt.datetime | None = None, fanout: int = FANOUT,
                 leaf_keys: int = LEAF_KEYS) -> int:
    """Marks rows that the source has deleted as gone; returns the rows left.
    ``relation`` is a table name or a query in brackets with a name; with
    ``source=None`` it is read from registered views."""
    now = _history(spark, snapshot_dir, table)[0]
    gone = deleted_rows(spark, source, relation, snapshot_dir, table, key, binary, fanout, leaf_keys)
    if gone is None:
        return now.row_count
    at = found_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    landed = F.greatest(F.lit(at).cast("timestamp"), F.col("__landed") + F.expr("INTERVAL 1 SECOND"))
    marked = gone.withColumns({"__gone": F.lit(True), "__landed": landed})
    if marked.isEmpty():
        return now.row_count
    return merge_rows(spark, snapshot_dir, table, marked, key, modified, now, now.upto)


def gone_keys(spark: SparkSession, snapshot_dir: str, table: str, key: str = "name") -> DataFrame:
    """Keys that the snapshot knows as deleted."""
    now = _history(spark, snapshot_dir, table)[0]
    rows = _bucket_rows(spark, snapshot_dir, table, now, manifest(spark, snapshot_dir, table, now))
    return rows.where("__gone").select(F.col(f"`{key}`"))
