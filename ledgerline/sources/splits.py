"""Splits of equal row count for parallel reads (SRC-1, SRC-5, SRC-6).

A read over JDBC runs one task per predicate. Fixed ranges (months of
``modified``) make a busy month one long task and an empty one a wasted
connection. Here the ranges follow the rows: the database ranks a sample of the
split columns in its own order and returns the rows at equal distances; these
are the bounds.

Bounds are tuples, compared column by column, so a value that very many rows
share (a bulk import with one ``modified``) is split by the next column: end the
list with a unique one. A null sorts before everything, as the database does it.
The predicates are disjoint and cover every row, whatever the bounds: a stale or
poor sample costs balance, never rows.

The database that compares also orders the bounds, so its collation holds on
both sides. All SQL here runs in the database as well as in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from .extract import JdbcSource, quote_table, read_query, sql_literal

SAMPLE_PER_SPLIT = 400
MAX_SAMPLE = 1_000_000
SEED = 17


def before_bound(columns: Sequence[str], bound: Sequence) -> str:
    """SQL: the row's columns sort before ``bound``."""
    name, value = quote_table(columns[0]), bound[0]
    lower = None if value is None else f"{name} IS NULL OR {name} < {sql_literal(value)}"
    if len(columns) == 1:
        return "1 = 0" if lower is None else f"({lower})"
    same = f"{name} IS NULL" if value is None else f"{name} = {sql_literal(value)}"
    tie = f"{same} AND {before_bound(columns[1:], bound[1:])}"
    return f"({tie})" if lower is None else f"({lower} OR {tie})"


def from_bound(columns: Sequence[str], bound: Sequence) -> str:
    """SQL: the row's columns are ``bound`` or sort after it."""
    name, value = quote_table(columns[0]), bound[0]
    higher = f"{name} IS NOT NULL" if value is None else f"{name} > {sql_literal(value)}"
    same = f"{name} IS NULL" if value is None else f"{name} = {sql_literal(value)}"
    rest = from_bound(columns[1:], bound[1:]) if len(columns) > 1 else None
    return f"({higher} OR {same}" + (f" AND {rest})" if rest else ")")


def range_predicates(columns: Sequence[str], bounds: Sequence[Sequence]) -> list[str]:
    """Disjoint predicates that cover all rows, one more than ``bounds`` (in
    the database's order)."""
    if not bounds:
        return ["1 = 1"]
    out = [before_bound(columns, bounds[0])]
    out += [f"{from_bound(columns, a)} AND {before_bound(columns, b)}"
            for a, b in zip(bounds, bounds[1:])]
    return [*out, from_bound(columns, bounds[-1])]


def plan_bounds(spark: SparkSession, source: JdbcSource | None, relation: str,
                columns: Sequence[str], splits: int, where: str | None = None,
                sample_per_split: int = SAMPLE_PER_SPLIT, seed: int = SEED) -> list[tuple]:
    """Bounds that cut the rows of ``relation`` (a table name, or a query in
    brackets with a name) into up to ``splits`` parts of about equal size.

    Two queries: a count, and a ranked sample of at most ``sample_per_split``
    rows a split (``MAX_SAMPLE`` in all), of which ``splits`` rows come back."""
    kept = f"({where})" if where else "1 = 1"
    total = read_query(spark, source, f"SELECT COUNT(*) AS n FROM {relation} WHERE {kept}").first()["n"]
    if splits <= 1 or total <= 1:
        return []
    share = min(1.0, min(splits * sample_per_split, MAX_SAMPLE) / total)
    drawn = "" if share == 1.0 else f" AND RAND({seed}) < {share:.12f}"
    names = ", ".join(quote_table(c) for c in columns)
    ranked = (f"SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS place_, COUNT(*) OVER () AS all_ "
              f"FROM {relation} WHERE {kept}{drawn}")
    rows = read_query(spark, source, f"SELECT {names}, place_ FROM ({ranked}) AS ranked WHERE place_ > 1 "
                                     f"AND MOD(place_ - 1, CEIL(all_ / {splits})) = 0").collect()
    bounds: list[tuple] = []
    for r in sorted(rows, key=lambda r: r["place_"]):
        bound = tuple(r[c] for c in columns)
        if not bounds or bound != bounds[-1]:
            bounds.append(bound)
    return bounds


def plan_splits(spark: SparkSession, source: JdbcSource | None, relation: str,
                columns: Sequence[str], splits: int, where: str | None = None,
                sample_per_split: int = SAMPLE_PER_SPLIT) -> list[str]:
    """Predicates over ``relation``, of about equal row count each."""
    return range_predicates(columns, plan_bounds(spark, source, relation, columns, splits, where,
                                                 sample_per_split))
