"""Differential check: every registered query against its SQL oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_sql import oracle_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    if isinstance(v, int):
        return (1, repr(float(v)))
    return (3, str(v))


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle_queries()) == set(E.erp_queries())


@pytest.mark.parametrize("name", sorted(E.erp_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expected)
    assert _canon(df.columns, rows) == _canon(cols, expected)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["supplier_id", "supplier_name"]
    assert df.count() > 0
