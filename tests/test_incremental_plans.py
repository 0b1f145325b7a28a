"""Running totals, hot-key lookups, key filters, kept-up sums and dimension
loads against plain versions, with the plans and failures that matter."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import hot_keys, key_filter, prefix, quality, relational
from ledgerline.plans import incremental, sales
from ledgerline.sources import compaction as C
from ledgerline.sources import extract as X

T = [dt.datetime(2026, 7, d) for d in range(1, 29)]


# -- running totals -----------------------------------------------------------

@pytest.mark.parametrize("within", [[], ["who"]])
def test_running_totals(spark, within):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), i if i % 50 else None, rng.choice([None, 1, 5, -2]))
            for i in range(3000)]
    rows = list({(w, d): (w, d, v) for w, d, v in rows}.values())
    frame = spark.createDataFrame(rows, "who string, day int, v int")
    order = ["day", "who"] if not within else ["day"]
    out = prefix.running_totals(frame.repartition(7), order, "v", "total", within)
    assert out.columns == ["who", "day", "v", "total"]
    sums, expected = {}, []
    for w, d, v in sorted(rows, key=lambda r: [(x is not None, x or 0 if not isinstance(x, str) else x)
                                              for x in ([r[1], r[0] or ""] if not within else [r[1]])]):
        key = w if within else None
        sums[key] = sums.get(key, 0) + (v or 0)
        expected.append((w, d, v, sums[key]))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    assert frame.limit(0).transform(
        lambda f: prefix.running_totals(f, order, "v", "total", within)).count() == 0


def test_running_totals_have_no_single_partition(spark):
    spark_rows = spark.range(5000).select("id", (F.col("id") % 13).cast("decimal(10,2)").alias("v"))
    out = prefix.running_totals(spark_rows, ["id"], "v", "total")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    last = out.orderBy(F.desc("id")).first()
    assert last.total == spark_rows.agg(F.sum("v")).first()[0] == Decimal(last.total)


# -- hot keys -----------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(
        F.col("id") % 997)
    return (spark.range(n).select("id", key.cast("int").alias("k")),
            spark.range(0, 900).select(F.col("id").cast("int").alias("pk"), F.concat(F.lit("n"), "id").alias("label")))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_of_hot_keys_equals_lookup(spark, skewed, how):
    fact, dim = skewed
    spread = hot_keys.lookup_spread(fact, dim, "k", "pk", ["label"], how)
    plain = relational.lookup(fact, dim, "k", "pk", ["label"], how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()
    assert hot_keys.frequent_keys(fact, "k") == [1]
    empty = hot_keys.lookup_spread(fact.limit(0), dim, "k", "pk", ["label"], how)
    assert empty.columns == plain.columns and empty.isEmpty()


def test_hot_key_rows_are_not_shuffled(spark, skewed):
    fact, dim = skewed
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p"))
                            .count().collect()]
        plain = sizes(relational.lookup(fact, dim, "k", "pk", ["label"]))
        spread = sizes(hot_keys.lookup_spread(fact, dim, "k", "pk", ["label"]))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(plain) > 2 * statistics.median(plain)
    assert max(spread) <= 2 * statistics.median(spread)


# -- key filters --------------------------------------------------------------

def keys_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_key_filter_misses_no_key(spark):
    old = spark.range(0, 40_000, 2).select("id", F.concat(F.lit("k"), "id").alias("name"))
    bits = key_filter.filter_bits(20_000)
    held = key_filter.key_filter(old, ["id", "name"], bits)
    asked = spark.range(40_000).select("id", F.concat(F.lit("k"), "id").alias("name"))
    found = key_filter.possible_keys(asked, ["id", "name"], held)
    assert old.exceptAll(found).isEmpty()
    assert found.count() - 20_000 < 0.03 * 20_000
    # filters of parts merge into the filter of the whole
    parts = [key_filter.key_filter(old.where(F.col("id") % 4 == i), ["id", "name"], bits) for i in (0, 2)]
    assert keys_of(key_filter.merged_filters(*parts)) == keys_of(held)


def test_a_key_is_one_row_of_its_bitmap(spark):
    """A filter is stored, and keys meet it as one row each, not one per bit."""
    held = key_filter.key_filter(spark.range(30_000), ["id"], key_filter.filter_bits(30_000))
    assert "key-filter" in held.inputFiles()[0] and held.count() == held.select("block").distinct().count()
    asked = key_filter.possible_keys(spark.range(25_000, 60_000), ["id"], held)
    assert "Generate" not in asked._jdf.queryExecution().executedPlan().toString()
    assert spark.range(25_000, 30_000).exceptAll(asked).isEmpty() and asked.count() < 5000 + 0.03 * 30_000


def test_increment_checks_equal_the_checks_of_the_union(spark):
    old = spark.range(5000).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"))
    new = spark.range(4900, 5300).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"))
    new = new.union(new.where("a < 5010")).union(spark.createDataFrame([(None, 1), (7, None), (6000, 0)],
                                                                       "a long, b long"))
    held = key_filter.key_filter(old, ["a", "b"], key_filter.filter_bits(5000))
    found = key_filter.pk_violations_of_increment(new, ["a", "b"], held, lambda keys: old)
    assert keys_of(found) == keys_of(quality.pk_violations(old.union(new), ["a", "b"]))
    facts = spark.createDataFrame([(i, i * 40 if i % 9 else None) for i in range(300)], "f long, a long")
    lost = key_filter.fk_orphans_of_increment(
        facts, "a", key_filter.key_filter(old, ["a"], key_filter.filter_bits(5000)), "a", lambda keys: old)
    assert keys_of(lost) == keys_of(quality.fk_orphans(facts, "a", old, "a"))
    none = key_filter.key_filter(old.limit(0), ["a", "b"], key_filter.filter_bits(0))
    assert keys_of(key_filter.pk_violations_of_increment(new, ["a", "b"], none, None)) == keys_of(
        quality.pk_violations(new, ["a", "b"]))


def test_new_keys_do_not_read_the_old_table(spark, tmp_dir):
    old = spark.range(1000).select("id")
    old.write.parquet(f"{tmp_dir}/old")
    held = key_filter.key_filter(spark.read.parquet(f"{tmp_dir}/old"), ["id"], 1 << 20)
    held.write.parquet(f"{tmp_dir}/filter")
    new = spark.createDataFrame([(10_001,), (10_001,), (10_002,)], "id long")

    def refuse(keys):
        raise AssertionError("read")

    out = key_filter.pk_violations_of_increment(new, ["id"], spark.read.parquet(f"{tmp_dir}/filter"), refuse)
    assert keys_of(out) == [(10_001, 2)]
    assert f"{tmp_dir}/old" not in out._jdf.queryExecution().executedPlan().toString()


def test_hits_read_only_their_buckets(spark, tmp_dir, monkeypatch):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    rows = spark.range(400).select(F.concat(F.lit("k"), "id").alias("name"), F.lit(T[0]).alias("modified"))
    X.write_parquet(rows, X.landing_path(landing, "t", "p1"))
    C.compact_table(spark, landing, snapshot, "t", "t", bucket_rows=20)
    asked = []
    real = C._bucket_rows
    monkeypatch.setattr(C, "_bucket_rows", lambda *a: asked.append(set(a[4])) or real(*a))
    some = spark.createDataFrame([("k3",), ("k4",)], "name string")
    assert some.join(C.rows_of_keys(spark, snapshot, "t", some), "name").count() == 2
    assert len(asked[0]) <= 2


# -- sums kept up by changes ----------------------------------------------------

INVOICES = "name string, posting_date date, base_grand_total decimal(18,2), docstatus int, modified timestamp_ntz"


def test_daily_sales_follow_every_change(spark, tmp_dir):
    landing, snapshot, state = (f"{tmp_dir}/{x}" for x in ("landing", "snapshot", "state"))
    d = [dt.date(2026, 7, i) for i in range(1, 10)]
    pulls = [
        [("a", d[0], Decimal("10"), 1, T[0]), ("b", d[0], Decimal("5"), 1, T[0]), ("c", d[1], Decimal("7"), 0, T[0]),
         ("e", d[4], Decimal("2"), 1, T[0])],
        # amount changed, day changed, submitted, new
        [("a", d[0], Decimal("12"), 1, T[1]), ("b", d[2], Decimal("5"), 1, T[1]), ("c", d[1], Decimal("7"), 1, T[1]),
         ("f", d[1], Decimal("1"), 1, T[1])],
        # cancelled, unchanged
        [("e", d[4], Decimal("2"), 2, T[2]), ("f", d[1], Decimal("1"), 1, T[1])],
    ]
    for i, rows in enumerate(pulls):
        X.write_parquet(spark.createDataFrame(rows, INVOICES), X.landing_path(landing, "tabSales Invoice", f"p{i}"))
        C.compact_landing(spark, landing, snapshot, {"sales_invoice": "tabSales Invoice"}, bucket_rows=2)
        kept = incremental.refresh_daily_sales(spark, snapshot, state)
        table = C.read_snapshot(spark, snapshot, "sales_invoice")
        whole = table.where("docstatus = 1").groupBy("posting_date").agg(F.sum("base_grand_total").alias("s"))
        assert {(r.posting_date, r.sales_today) for r in kept.collect()} == {
            (r.posting_date, r.s) for r in whole.collect()}
        for ours, theirs in ((sales.tracker_of_days, sales.target_tracker),
                             (sales.calendar_tracker_of_days, sales.calendar_target_tracker)):
            assert ours(kept, d[5], 3100).collect() == theirs(table, d[5], 3100).collect()
    again = incremental.refresh_daily_sales(spark, snapshot, state)
    assert again.inputFiles() == kept.inputFiles()      # nothing new, nothing written


def test_a_refresh_reads_changed_buckets_only(spark, tmp_dir, monkeypatch):
    landing, snapshot, state = (f"{tmp_dir}/{x}" for x in ("landing", "snapshot", "state"))
    day = dt.date(2026, 7, 1)
    first = [(f"i{i}", day, Decimal(1), 1, T[0]) for i in range(200)]
    for i, rows in enumerate((first, [("i7", day, Decimal(3), 1, T[1])])):
        X.write_parquet(spark.createDataFrame(rows, INVOICES), X.landing_path(landing, "t", f"p{i}"))
        C.compact_table(spark, landing, snapshot, "sales_invoice", "t", bucket_rows=10)
        asked = []
        real = C._bucket_rows
        with monkeypatch.context() as m:
            m.setattr(C, "_bucket_rows", lambda *a: asked.append(set(a[4])) or real(*a))
            kept = incremental.refresh_daily_sales(spark, snapshot, state)
    assert [len(x) for x in asked] == [1, 1]
    assert [(r.sales_today, r.n) for r in kept.collect()] == [(Decimal(202), 200)]


# -- dimensions -----------------------------------------------------------------

def test_dimension_loads_broadcast_no_old_rows(spark, tmp_dir, monkeypatch):
    """What changed is found by a merge: the driver is sent no digests."""
    import datetime as dt
    seen, merge = [], incremental.compaction.merge_rows
    monkeypatch.setattr(incremental.compaction, "merge_rows", lambda s, d, t, rows, *a: (
        seen.append(rows._jdf.queryExecution().executedPlan().toString()), merge(s, d, t, rows, *a))[1])
    rows = spark.range(50).select(F.col("id").cast("int").alias("customer_id"),
                                  F.lit("a").alias("customer_name"), F.lit("b").alias("country"))
    incremental.load_dimension(spark, "customers", rows, tmp_dir, dt.datetime(2001, 7, 1))
    changed = rows.withColumn("country", F.when(F.col("customer_id") > 9, F.lit("b")))
    assert incremental.load_dimension(spark, "customers", changed, tmp_dir, dt.datetime(2001, 7, 2)) == 10
    assert "Broadcast" not in seen[1] and "SortMergeJoin" in seen[1]


def test_dimension_loads_move_stamps_of_changed_rows(spark, tmp_dir):
    rows = lambda *r: spark.createDataFrame(r, "customer_id long, customer_name string, country string")
    load = lambda df, t: incremental.load_dimension(spark, "customers", df, tmp_dir, t)
    shown = lambda: {r.customer_id: (r.customer_name, r.country, r.created_at, r.updated_at)
                     for r in C.read_snapshot(spark, tmp_dir, "customers").collect()}
    assert load(rows((1, "A", "KE"), (2, "B", None), (3, "C", "")), T[0]) == 3
    assert load(rows((1, "A", "KE"), (2, "B", ""), (4, "D", "UG")), T[1]) == 2
    assert shown() == {1: ("A", "KE", T[0], T[0]), 2: ("B", "", T[0], T[1]), 3: ("C", "", T[0], T[0]),
                       4: ("D", "UG", T[1], T[1])}
    assert load(rows((1, "A", "KE"), (2, "B", ""), (4, "D", "UG")), T[2]) == 0
    assert C.current_version(spark, tmp_dir, "customers").version == 1
    load(rows((4, "old", "UG")), T[0])       # an older load run late
    assert shown()[4] == ("D", "UG", T[1], T[1])
    for bad in (rows((1, "A", "x"), (1, "B", "x")), rows((None, "A", "x"))):
        with pytest.raises(ValueError):
            load(bad, T[3])
    extra = spark.createDataFrame([(9, "gadget", 1.5, "clash")], "product_sku int, product_name string, "
                                  "unit_price double, `__digest` string")
    assert incremental.load_dimension(spark, "products", extra, tmp_dir, T[0]) == 1
