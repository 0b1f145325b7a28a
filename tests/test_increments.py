"""Bucketed snapshots, marks, planned splits, deletions and what is built on
the changes between versions."""

import datetime as dt
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import compaction as C
from ledgerline.sources import deletions as D
from ledgerline.sources import extract as X
from ledgerline.sources import marks as M
from ledgerline.sources import splits as S

T = [dt.datetime(2026, 7, d) for d in range(1, 29)]
SCHEMA = "name string, v int, modified timestamp_ntz"


def land(spark, landing, ds, rows, schema=SCHEMA):
    X.write_parquet(spark.createDataFrame(rows, schema), X.landing_path(landing, "tabOrder", ds))


def compact(spark, landing, snapshot, **kw):
    return C.compact_table(spark, landing, snapshot, "orders", "tabOrder", **kw)


def held(spark, snapshot, version=None):
    return {r.name: r.v for r in C.read_snapshot(spark, snapshot, "orders", version).collect()}


def data_files(snapshot):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{snapshot}/data") for f in fs
            if f.endswith(".parquet")}


# -- buckets ------------------------------------------------------------------

@pytest.fixture()
def bucketed(spark, tmp_dir):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    land(spark, landing, "2026-07-01", [(f"k{i}", 1, T[0]) for i in range(400)])
    assert compact(spark, landing, snapshot, bucket_rows=20) == 400
    return landing, snapshot


def test_untouched_buckets_keep_their_files(spark, bucketed):
    landing, snapshot = bucketed
    first = C.current_version(spark, snapshot, "orders")
    assert first.buckets == 20
    before = C.manifest(spark, snapshot, "orders", first)
    files = data_files(snapshot)
    land(spark, landing, "2026-07-02", [("k7", 2, T[1]), ("new", 2, T[1])])
    assert compact(spark, landing, snapshot) == 401
    now = C.current_version(spark, snapshot, "orders")
    after = C.manifest(spark, snapshot, "orders", now)
    touched = {r[0] for r in spark.createDataFrame([("k7",), ("new",)], "name string").select(
        C.bucket_of("name", 20)).collect()}
    assert {b for b in after if after[b] != before.get(b)} == touched
    new_files = data_files(snapshot) - files
    assert files <= data_files(snapshot)
    assert {f.split("__bucket=")[1].split("/")[0] for f in new_files} == {str(b) for b in touched}
    values = held(spark, snapshot)
    assert values["k7"] == 2 and values["new"] == 2 and len(values) == 401
    assert held(spark, snapshot, version=0)["k7"] == 1      # older versions stay readable


def test_a_merge_reads_touched_buckets_only(spark, bucketed, monkeypatch):
    landing, snapshot = bucketed
    asked = []
    real = C._bucket_rows
    monkeypatch.setattr(C, "_bucket_rows", lambda *a: asked.append(set(a[4])) or real(*a))
    land(spark, landing, "2026-07-02", [("k7", 2, T[1])])
    compact(spark, landing, snapshot)
    assert len(asked) == 1 and len(asked[0]) == 1


def test_null_keys_are_one_key(spark, tmp_dir):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    for day in range(1, 4):
        land(spark, landing, f"2026-07-0{day}", [(None, day, T[day]), ("a", day, T[day])])
        assert compact(spark, landing, snapshot) == 2
    assert held(spark, snapshot) == {None: 3, "a": 3}


def test_an_uncommitted_pull_waits(spark, tmp_dir):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    land(spark, landing, "2026-07-01", [("a", 1, T[0])])
    land(spark, landing, "2026-07-02", [("a", 2, T[1]), ("b", 2, T[1])])
    marker = f"{X.landing_path(landing, 'tabOrder', '2026-07-02')}/_SUCCESS"
    os.rename(marker, marker + ".later")
    assert compact(spark, landing, snapshot) == 1
    os.rename(marker + ".later", marker)
    assert compact(spark, landing, snapshot) == 2
    assert held(spark, snapshot) == {"a": 2, "b": 2}


def test_a_pull_that_is_written_again_is_taken_again(spark, tmp_dir):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    land(spark, landing, "2026-07-01", [("a", 1, T[0])])
    compact(spark, landing, snapshot)
    land(spark, landing, "2026-07-01", [("a", 1, T[0]), ("b", 1, T[0])])
    assert compact(spark, landing, snapshot) == 2
    pulls = C.landed_pulls(spark, f"{landing}/taborder")
    assert [p.ds for p in pulls] == ["2026-07-01"]
    assert C.pulls_not_taken(spark, f"{landing}/taborder", snapshot, "orders",
                             C._history(spark, snapshot, "orders")) == []


def test_of_two_runs_at_once_one_is_kept(spark, bucketed, monkeypatch):
    """Both start from version 0; what the loser took is taken again."""
    landing, snapshot = bucketed
    stale = C._history(spark, snapshot, "orders")
    land(spark, landing, "2026-07-02", [("k1", 2, T[1])])
    compact(spark, landing, snapshot)
    land(spark, landing, "2026-07-03", [("k2", 3, T[2])])
    with monkeypatch.context() as m:        # a run that has not seen version 1
        m.setattr(C, "_history", lambda *a: stale)
        m.setattr(C, "pulls_not_taken", lambda *a: [
            p for p in C.landed_pulls(spark, f"{landing}/taborder") if p.ds == "2026-07-03"])
        compact(spark, landing, snapshot)
    compact(spark, landing, snapshot)
    values = held(spark, snapshot)
    assert (values["k1"], values["k2"], len(values)) == (2, 3, 400)


def test_new_columns_join_old_buckets(spark, bucketed):
    landing, snapshot = bucketed
    land(spark, landing, "2026-07-02", [("k7", 2, T[1], "x")], SCHEMA + ", note string")
    compact(spark, landing, snapshot)
    rows = {r.name: r.note for r in C.read_snapshot(spark, snapshot, "orders").collect()}
    assert len(rows) == 400 and rows["k7"] == "x" and rows["k8"] is None


def test_changed_rows_between_versions(spark, bucketed):
    landing, snapshot = bucketed
    land(spark, landing, "2026-07-02", [("k7", 2, T[1]), ("new", 2, T[1]), ("k9", 1, T[0])])
    compact(spark, landing, snapshot)
    changes = {r.name: (r.before and r.before.v, r.after and r.after.v)
               for r in C.changed_rows(spark, snapshot, "orders", 0).collect()}
    assert changes == {"k7": (1, 2), "new": (None, 2)}
    assert C.changed_rows(spark, snapshot, "orders", None, 0).count() == 400
    assert C.changed_rows(spark, snapshot, "orders", 1).count() == 0


# -- marks --------------------------------------------------------------------

def source_state(spark, root, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{root}/tabOrder")
    return X.ParquetSource(root)


def test_three_pulls_with_a_crash_lose_no_row(spark, tmp_dir, monkeypatch):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    rows = [("a", 1, T[0]), ("b", 1, T[1]), ("n", 1, None)]
    src = source_state(spark, f"{tmp_dir}/s1", rows)
    one = M.pull_increment(spark, src, "tabOrder", landing, "p1", began=T[2])
    assert (one.rows, one.bound, one.seen) == (3, None, T[1])

    rows = [("a", 2, T[3]), *rows[1:], ("c", 2, T[3])]
    src = source_state(spark, f"{tmp_dir}/s2", rows)
    with monkeypatch.context() as m:        # dies after landing, before its mark
        m.setattr(M, "_marks_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
                  if os.path.isdir(X.landing_path(landing, "tabOrder", "p2")) else f"{landing}/_marks/taborder")
        with pytest.raises(RuntimeError):
            M.pull_increment(spark, src, "tabOrder", landing, "p2", began=T[4])
    assert M.marks(spark, landing, "tabOrder").count() == 1

    rows = [*rows[:2], ("n", 3, None), ("c", 3, T[5]), ("d", 3, T[5])]
    src = source_state(spark, f"{tmp_dir}/s3", rows)
    three = M.pull_increment(spark, src, "tabOrder", landing, "p3", began=T[6])
    assert three.bound == T[1] - M.OVERLAP and three.rows == 5
    compact(spark, landing, snapshot)
    assert held(spark, snapshot) == {"a": 2, "b": 1, "n": 3, "c": 3, "d": 3}


def test_marks_move_with_care(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    pull = lambda rows, ds, began: M.pull_increment(
        spark, source_state(spark, f"{tmp_dir}/{ds}-{began:%d}", rows), "tabOrder", landing, ds, began=began)
    future = dt.datetime(2099, 1, 1)
    pull([("a", 1, future)], "p1", T[2])
    two = pull([("a", 1, future), ("late", 1, T[2])], "p2", T[3])
    assert two.bound == T[2] - M.OVERLAP and two.rows == 2       # not 2099
    assert pull([], "p3", T[4]).seen is None
    assert M.next_bound(spark, landing, "tabOrder", "p4") == T[3] - M.OVERLAP    # no rows, no move
    again = pull([("a", 1, future), ("late", 1, T[2]), ("x", 1, T[3])], "p2", T[5])
    assert again.bound == two.bound and again.rows == 3          # replaces its own folder


def test_marked_read_pushes_its_bound_down(spark, tmp_dir):
    src = source_state(spark, f"{tmp_dir}/s", [("a", 1, T[0]), ("b", 1, T[5])])
    df = X.read_table(spark, src, "tabOrder", where=f"`modified` >= {X.sql_literal(T[3])} OR `modified` IS NULL")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(modified" in plan and "IsNull(modified)" in plan


# -- splits -------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A busy day, an import with one timestamp, rows without one, text keys."""
    rng = random.Random(4)
    rows = [(f"N-{rng.randrange(10**9)}'\\", T[rng.randrange(20)] + dt.timedelta(seconds=rng.randrange(86400)))
            for _ in range(3000)]
    rows += [(f"B-{i}", T[25] + dt.timedelta(milliseconds=i)) for i in range(9000)]
    rows += [(f"I-{i}", dt.datetime(2024, 1, 1)) for i in range(6000)]
    rows += [(f"U-{i}", None) for i in range(2500)] + [(None, None), (None, T[3])]
    frame = spark.createDataFrame(rows, "name string, modified timestamp_ntz")
    frame.createOrReplaceTempView("skewed")
    return frame


@pytest.mark.parametrize("columns", [["modified", "name"], ["name"], ["name", "modified"]])
def test_planned_splits_are_even_disjoint_and_complete(spark, skewed, columns):
    predicates = S.plan_splits(spark, None, "skewed", columns, 12)
    assert len(predicates) == 12
    sizes = [skewed.where(p).count() for p in predicates]
    assert sum(sizes) == skewed.count()
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0))
    assert skewed.where(hits != 1).count() == 0
    assert max(sizes) <= 2 * statistics.median(sizes)


def test_splits_from_a_poor_sample_lose_nothing(spark, skewed):
    predicates = S.plan_splits(spark, None, "skewed", ["modified", "name"], 9, sample_per_split=2)
    assert sum(skewed.where(p).count() for p in predicates) == skewed.count()
    # bounds in no order at all: still every row, by each predicate's own words
    assert S.range_predicates(["a"], []) == ["1 = 1"]
    assert S.range_predicates(["a"], [(None,)]) == ["1 = 0", "(`a` IS NOT NULL OR `a` IS NULL)"]
    assert S.plan_splits(spark, None, "skewed", ["name"], 4, where="1 = 0") == ["1 = 1"]


def test_numeric_and_date_splits(spark):
    frame = spark.range(1000).select((F.col("id") * F.col("id")).alias("k"),
                                     F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"))
    frame.createOrReplaceTempView("squares")
    for columns in (["k"], ["d", "k"]):
        sizes = [frame.where(p).count() for p in S.plan_splits(spark, None, "squares", columns, 7)]
        assert sum(sizes) == 1000 and max(sizes) <= 2 * statistics.median(sizes)


def test_a_jdbc_table_is_read_by_planned_splits(monkeypatch):
    from test_extract import _Session

    seen = {}
    monkeypatch.setattr(S, "read_query", lambda spark, source, query, *a: seen.setdefault(
        "queries", []).append(query) or _Rows(query))

    class _Rows:
        def __init__(self, query):
            self.query = query

        def first(self):
            return {"n": 1000}

        def collect(self):
            return [{"modified": T[3], "name": "x'y", "place_": 501}]


    s = _Session()
    X.read_table(s, X.JdbcSource("db", "u", "p"), "tabGL Entry", splits=2, split_by=["modified", "name"])
    assert s.read.asked["predicates"] == [
        "(`modified` IS NULL OR `modified` < '2026-07-04 00:00:00' OR `modified` = '2026-07-04 00:00:00' "
        "AND (`name` IS NULL OR `name` < 'x''y'))",
        "(`modified` > '2026-07-04 00:00:00' OR `modified` = '2026-07-04 00:00:00' AND (`name` > 'x''y' OR "
        "`name` = 'x''y'))"]
    assert all("FROM `tabGL Entry` WHERE 1 = 1" in q for q in seen["queries"])
    S.plan_splits(s, X.JdbcSource("db", "u", "p"), "`t`", ["name"], 2, where="docstatus = 1")
    assert all("FROM `t` WHERE (docstatus = 1)" in q for q in seen["queries"][2:])


def test_query_extract_is_split(spark, skewed, tmp_dir):
    query = "SELECT name, date(modified) AS day, length(name) AS size FROM skewed WHERE name <> :no"
    whole = spark.sql(query, args={"no": "B-7"})
    path, rows = X.extract_query_to_landing(spark, None, query, f"{tmp_dir}/q", {"no": "B-7"},
                                            split_by=["day", "name"], splits=6)
    assert rows == whole.count()
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, whole.collect()))
    predicates = S.plan_splits(spark, None, f"({X.bind_parameters(query, {'no': 'B-7'})}) AS q",
                               ["day", "name"], 6)
    read = X.read_query(spark, None, query, {"no": "B-7"}, predicates)
    assert len(predicates) == 6 and read.rdd.getNumPartitions() >= 6
    with pytest.raises(ValueError):
        X.extract_query_to_landing(spark, None, query, f"{tmp_dir}/q2", {"no": ""}, splits=6)


# -- deletions ----------------------------------------------------------------

@pytest.mark.parametrize("kind", ["string", "long"])
def test_deleted_rows_vanish_and_equal_ranges_are_not_read(spark, tmp_dir, monkeypatch, kind):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    key = (lambda i: f"k{i:05d}") if kind == "string" else (lambda i: i)
    schema = f"name {kind}, v int, modified timestamp_ntz"
    rows = [(key(i), i, T[0]) for i in range(5000)]
    land(spark, landing, "p1", rows, schema)
    compact(spark, landing, snapshot, bucket_rows=100)
    gone = {key(i) for i in (0, 17, 18, 2500, 4999)}
    source = [r for r in rows if r[0] not in gone] + [(key(6001), 1, T[1])]     # one not pulled yet
    spark.createDataFrame(source, schema).createOrReplaceTempView("tab_order_now")
    asked = []
    real = D.read_query
    monkeypatch.setattr(D, "read_query", lambda s, src, q, *a: asked.append(q) or real(s, src, q, *a))
    files = data_files(snapshot)
    before = C.current_version(spark, snapshot, "orders")
    left = D.drop_deleted(spark, None, "tab_order_now", snapshot, "orders", fanout=8, leaf_keys=100,
                          found_at=T[2])
    assert left == 4995
    assert {r.name for r in C.read_snapshot(spark, snapshot, "orders").collect()} == {
        r[0] for r in rows} - gone
    assert {r.name for r in D.gone_keys(spark, snapshot, "orders").collect()} == gone
    # keys were fetched from a few of fifty ranges, files written for a few buckets
    fetch = [q for q in asked if q.startswith("SELECT `name` FROM tab_order_now")]
    assert len(fetch) == 1
    fetched = spark.sql(fetch[0]).count()
    assert fetched < 800
    now = C.current_version(spark, snapshot, "orders")
    old, new = (C.manifest(spark, snapshot, "orders", v) for v in (before, now))
    assert files <= data_files(snapshot) and sum(new[b] != old[b] for b in new) <= len(gone)
    # nothing more to find but the row that is not pulled yet
    assert D.drop_deleted(spark, None, "tab_order_now", snapshot, "orders", leaf_keys=100) == 4995
    # an old pull found late does not bring a row back, a newer version does
    land(spark, landing, "p2", [(key(17), 17, T[0]), (key(18), 99, T[5])], schema)
    C_late = C.landed_pulls(spark, f"{landing}/taborder")[-1].path
    for d, _, fs in os.walk(C_late):
        for f in fs:
            if f.endswith(".parquet"):
                os.utime(os.path.join(d, f), (T[1].timestamp(), T[1].timestamp()))
    assert compact(spark, landing, snapshot) == 4996
    values = held(spark, snapshot)
    assert values[key(18)] == 99 and key(17) not in values


def test_equal_tables_have_no_deleted_rows(spark, tmp_dir):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    land(spark, landing, "p1", [("a", 1, T[0]), ("b", 1, T[0])])
    compact(spark, landing, snapshot)
    spark.createDataFrame([("b",), ("a",)], "name string").createOrReplaceTempView("same_keys")
    assert D.drop_deleted(spark, None, "same_keys", snapshot, "orders") == 2
    assert C.current_version(spark, snapshot, "orders").version == 0
    spark.createDataFrame([], "name string").createOrReplaceTempView("no_keys")
    assert D.drop_deleted(spark, None, "no_keys", snapshot, "orders") == 0
    assert C.read_snapshot(spark, snapshot, "orders").count() == 0
