"""Extraction, landing and merge of increments (SRC-*, SNK-*, MRG-1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators.aggregates import latest_per_key
from ledgerline.sources import extract as X


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_path_and_table_names():
    assert X.landing_path("/out/", "tabSales Invoice") == "/out/tabsales_invoice/ds=manual_run"
    assert X.landing_path("/out", "tabGL Entry", "2026-07-01") == "/out/tabgl_entry/ds=2026-07-01"
    assert X.quote_table("tabSales Invoice") == "`tabSales Invoice`"


def test_jdbc_settings_from_env():
    env = {"ERP_DB_HOST": "db", "ERP_DB_USER": "u", "ERP_DB_PASSWORD": "s3cr3t"}
    src = X.JdbcSource.from_env(environ=env)
    assert src.url == "jdbc:mysql://db:3306/erpnext?permitMysqlScheme"
    opts = src.options()
    assert opts["fetchsize"] == "50000" and opts["user"] == "u"
    assert "s3cr3t" not in repr(src)
    env.update(ERP_DB_PORT="3307", ERP_DB_NAME="erp")
    assert X.JdbcSource.from_env(environ=env).url == "jdbc:mysql://db:3307/erp?permitMysqlScheme"
    mysql = X.JdbcSource("db", "u", "p", driver="com.mysql.cj.jdbc.Driver")
    assert mysql.url.endswith("?useCursorFetch=true")


def test_jdbc_url_selects_the_mysql_dialect(spark):
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(X.JdbcSource("db", "u", "p").url)
    assert dialect.getClass().getSimpleName() == "MySQLDialect"
    assert dialect.quoteIdentifier("modified by") == "`modified by`"


class _Reader:
    """Stands for ``spark.read`` and notes what it is asked."""

    def __init__(self):
        self.asked = {}

    def jdbc(self, url, table, predicates=None, properties=None):
        self.asked = {"url": url, "table": table, "predicates": predicates, "properties": properties}
        return "read"

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **kw):
        self.asked.update(kw)
        return self

    def option(self, k, v):
        self.asked[k] = v
        return self

    def load(self):
        return "read"


class _Session:
    def __init__(self):
        self.read = _Reader()


def test_jdbc_reads_are_split():
    src, s = X.JdbcSource("db", "u", "p"), _Session()
    X.read_table(s, src, "tabGL Entry")
    asked = s.read.asked
    assert asked["table"] == "`tabGL Entry`" and len(asked["predicates"]) > 100
    assert asked["predicates"][0] == "`modified` < '2015-01-01' OR `modified` IS NULL"
    assert asked["properties"]["fetchsize"] == "50000" and "url" not in asked["properties"]
    assert asked["properties"]["driver"] == "org.mariadb.jdbc.Driver"
    X.read_table(s, src, "t", split_from="2026-01-01", split_to="2026-02-01")
    assert len(s.read.asked["predicates"]) == 4
    X.read_table(s, src, "t", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=3)
    assert s.read.asked["numPartitions"] == "3"
    with pytest.raises(ValueError):
        X.read_table(s, src, "t", split_column=None)
    with pytest.raises(ValueError):
        X.read_table(s, src, "t", partition_column="id")


def test_query_parameters_are_bound_over_jdbc():
    src, s = X.JdbcSource("db", "u", "p"), _Session()
    query = ("SELECT ':no', `a:b`, x FROM t WHERE d >= :start AND n IN :names AND q = :q "
             "AND z IS :z AND t = '10:30'")
    params = {"start": dt.date(2026, 7, 1), "names": ["O'Hara", "a\\b"], "q": True, "z": None}
    bound = ("SELECT ':no', `a:b`, x FROM t WHERE d >= '2026-07-01' AND n IN ('O''Hara', 'a\\\\b') "
             "AND q = 1 AND z IS NULL AND t = '10:30'")
    assert X.bind_parameters(query, params) == bound
    X.read_query(s, src, query, params)
    assert s.read.asked["query"] == bound
    X.read_query(s, src, query, params, predicates=["x < 3", "x >= 3 OR x IS NULL"])
    assert s.read.asked["table"] == f"({bound}) AS q" and len(s.read.asked["predicates"]) == 2
    with pytest.raises(KeyError):
        X.bind_parameters("SELECT :missing", {})


def test_modified_ranges_cover_everything(spark):
    preds = X.modified_ranges("2026-01-15", "2026-03-02")
    assert len(preds) == 5
    rows = spark.sql("SELECT * FROM VALUES (CAST(NULL AS DATE)), (DATE '1999-01-01'), "
                     "(DATE '2026-01-01'), (DATE '2026-02-28'), (DATE '2026-03-31'), "
                     "(DATE '2031-01-01') AS t(modified)")
    assert [rows.where(p).count() for p in preds] == [2, 1, 1, 1, 1]


def test_pruned_filtered_extract_pushes_down(spark, tmp_dir):
    src = X.ParquetSource(SF_SMALL)
    df = X.read_table(spark, src, "orders.parquet", columns=["o_orderkey", "o_orderdate"],
                      where=F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("1998-01-01")))
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    path, rows = X.extract_to_landing(spark, src, "orders.parquet", tmp_dir, ds="2001-07-15",
                                      columns=["o_orderkey", "o_orderdate"],
                                      where=F.col("o_orderdate") >= F.to_timestamp_ntz(
                                          F.lit("1998-01-01")))
    assert path.endswith("/orders.parquet/ds=2001-07-15")
    back = spark.read.parquet(path)
    assert back.count() == rows == df.count() > 0
    assert back.columns == ["o_orderkey", "o_orderdate"]


def test_empty_extract_keeps_schema_and_overwrites(spark, tmp_dir):
    src = X.ParquetSource(SF_SMALL)
    path = f"{tmp_dir}/cust"
    assert X.write_parquet(X.read_table(spark, src, "customer.parquet"), path) > 0
    empty = X.read_table(spark, src, "customer.parquet", where=F.col("c_custkey") < 0)
    assert X.write_parquet(empty, path) == 0
    back = spark.read.parquet(path)
    assert back.count() == 0
    assert back.schema == spark.read.parquet(f"{SF_SMALL}/customer.parquet").schema


def test_overlapping_increments_merge_to_latest(spark):
    old = spark.createDataFrame(
        [("A", dt.datetime(2026, 7, 1), 1), ("B", dt.datetime(2026, 7, 1), 2),
         ("C", dt.datetime(2026, 6, 30), 3)], "name string, modified timestamp_ntz, v int")
    new = spark.createDataFrame(
        [("A", dt.datetime(2026, 7, 2), 10), ("B", dt.datetime(2026, 7, 1), 2),
         ("D", dt.datetime(2026, 7, 2), 4)], "name string, modified timestamp_ntz, v int")
    merged = latest_per_key(old.unionByName(new), ["name"], ["modified"])
    got = {r.name: r.v for r in merged.collect()}
    assert got == {"A": 10, "B": 2, "C": 3, "D": 4}
    assert merged.columns == ["name", "modified", "v"]
    assert "Window" not in _plan(merged)


def test_read_query_binds_parameters(spark):
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").createOrReplaceTempView("nation_v")
    df = X.read_query(spark, None, "SELECT n_name FROM nation_v WHERE n_nationkey = :k",
                      {"k": 3})
    assert df.count() == 1


def test_query_extract_lands_bound_result(spark, tmp_dir):
    spark.read.parquet(f"{SF_SMALL}/region.parquet").createOrReplaceTempView("region_v")
    path, rows = X.extract_query_to_landing(
        spark, None, "SELECT r_name FROM region_v WHERE r_regionkey >= :k", f"{tmp_dir}/q",
        {"k": 3})
    assert rows == 2 and spark.read.parquet(path).count() == 2


def test_invoice_load_appends_loads_and_reruns_idempotently(spark, tmp_dir):
    from ledgerline.plans.models import sales_invoice_load
    si = spark.createDataFrame([("SI-1", "acme"), ("SI-2", "beta")],
                               "name string, customer_name string")
    target = f"{tmp_dir}/target"
    sales_invoice_load(si, target, "2026-07-01", "a")
    sales_invoice_load(si.where("name = 'SI-1'"), target, "2026-07-02", "b")
    sales_invoice_load(si.where("name = 'SI-2'"), target, "2026-07-02", "c")    # same day
    out = sales_invoice_load(si.where("name = 'SI-2'"), target, "2026-07-02", "c")   # re-run
    assert sorted((str(r.last_updated), r.load_id, r.customer_name) for r in out.collect()) == [
        ("2026-07-01", "a", "ACME"), ("2026-07-01", "a", "BETA"), ("2026-07-02", "b", "ACME"),
        ("2026-07-02", "c", "BETA")]
    assert sales_invoice_load(si, target, "2026-07-02").count() == 6    # no id: a load of its own


def test_sql_over_registered_views_with_parameters(spark):
    import datetime as dt

    from ledgerline.sources.extract import read_query
    from ledgerline.sources.testbed import landed_testbed, register_views

    views = register_views(landed_testbed(spark, SF_SMALL))
    assert "erp_gl_entry" in views
    df = read_query(spark, None,
                    "SELECT account, SUM(debit) AS d FROM erp_gl_entry "
                    "WHERE posting_date BETWEEN :start AND :end AND is_cancelled = 0 "
                    "GROUP BY account",
                    {"start": dt.date(2001, 6, 1), "end": dt.date(2001, 6, 30)})
    assert df.count() > 0


def test_pulls_compact_into_report_tables(spark, tmp_dir):
    import datetime as dt

    from ledgerline.plans import sales
    from ledgerline.sources.compaction import SnapshotTables, compact_landing

    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    schema = ("name string, posting_date date, base_grand_total decimal(18,2), "
              "docstatus int, modified timestamp")
    t1, t2 = dt.datetime(2026, 7, 1, 8), dt.datetime(2026, 7, 2, 8)
    d = dt.date(2026, 7, 1)
    from decimal import Decimal as D
    pull1 = spark.createDataFrame([("SI-1", d, D("10.00"), 1, t1), ("SI-2", d, D("5.00"), 0, t1)],
                                  schema)
    # next day's pull overlaps: SI-1 unchanged, SI-2 submitted, SI-3 new
    pull2 = spark.createDataFrame([("SI-1", d, D("10.00"), 1, t1), ("SI-2", d, D("5.00"), 1, t2),
                                   ("SI-3", d, D("1.00"), 1, t2)], schema)
    src = {"sales_invoice": "tabSales Invoice"}
    for ds, pull in (("2026-07-01", pull1), ("2026-07-02", pull2)):
        X.write_parquet(pull, X.landing_path(landing, "tabSales Invoice", ds))
    layout = {"sales_invoice": ("range", ("posting_date", "name"))}
    assert compact_landing(spark, landing, snapshot, src, layout=layout) == {"sales_invoice": 3}
    t = SnapshotTables(spark, snapshot)
    daily = sales.daily_sales(t.sales_invoice).collect()
    assert [(r.posting_date, r.TOTAL_DAILY_SALES) for r in daily] == [(d, 16.0)]


def test_compaction_takes_latest_pull_without_modified(spark, tmp_dir):
    from ledgerline.sources.compaction import compact_landing, read_snapshot

    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"
    tables = {"company": "tabCompany"}

    def land(ds, *names):
        X.write_parquet(spark.createDataFrame([(n,) for n in names], "name string"),
                        X.landing_path(landing, "tabCompany", ds))

    land(None, "MANUAL")
    land("2026-07-01", "MAIN", "OLD")
    land("2026-07-02", "MAIN")
    assert compact_landing(spark, landing, snapshot, tables) == {"company": 1}
    assert [r.name for r in read_snapshot(spark, snapshot, "company").collect()] == ["MAIN"]
    assert compact_landing(spark, landing, snapshot, tables) == {"company": 1}      # nothing new
    land(None, "MAIN", "NEW")
    assert compact_landing(spark, landing, snapshot, tables) == {"company": 2}


def _orders_landing(spark, tmp_dir):
    landing, snapshot = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot"

    def land(ds, *rows):
        X.write_parquet(spark.createDataFrame(rows, "name string, v int, modified timestamp_ntz"),
                        X.landing_path(landing, "tabOrder", ds))
    return landing, snapshot, land


def test_compaction_orders_by_modified_then_landing(spark, tmp_dir):
    from ledgerline.sources.compaction import compact_landing, read_snapshot

    landing, snapshot, land = _orders_landing(spark, tmp_dir)
    t1, t2 = dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 2)
    land("2026-07-01", ("tie", 9, t1), ("old", 9, t1), ("null", 9, None), ("late", 9, t2))
    land(None, ("tie", 5, t1), ("null", 5, None))
    compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    values = lambda: {r.name: r.v for r in read_snapshot(spark, snapshot, "orders").collect()}
    assert values() == {"tie": 5, "old": 9, "null": 5, "late": 9}
    land("2026-07-02", ("tie", 1, t1), ("null", 1, t1), ("late", 1, t1), ("new", 1, None))
    compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    assert values() == {"tie": 1, "old": 9, "null": 1, "late": 9, "new": 1}


def test_compaction_reads_new_pulls_only(spark, tmp_dir):
    from ledgerline.sources import compaction as C

    landing, snapshot, land = _orders_landing(spark, tmp_dir)
    land("2026-07-01", ("a", 1, None))
    C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    land("2026-07-02", ("b", 1, None))
    upto = C.current_version(spark, snapshot, "orders").upto
    new = C.landed_since(spark, f"{landing}/taborder", upto)
    assert [r.name for r in new.collect()] == ["b"]
    plan = new._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    assert leaf.metrics().get("numFiles").get().value() < len(new.inputFiles()) + 8
    assert "file_modification_time" in plan.toString()


def _set_landing_time(folder, seconds):
    import os
    from pathlib import Path

    for f in Path(folder).rglob("*.parquet"):
        os.utime(f, (seconds, seconds))


def test_compaction_takes_files_published_late(spark, tmp_dir):
    from ledgerline.sources import compaction as C

    landing, snapshot, land = _orders_landing(spark, tmp_dir)
    t1, t2 = dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 2)
    land("2026-07-02", ("a", 1, t2), ("tie", 1, None))
    C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    # published after the compaction, with files written an hour before its pull
    land("2026-07-01", ("a", 2, t1), ("b", 2, t1), ("tie", 2, None))
    upto = C.current_version(spark, snapshot, "orders").upto
    _set_landing_time(X.landing_path(landing, "tabOrder", "2026-07-01"), upto.timestamp() - 3600)
    expected = {"a": 1, "b": 2, "tie": 1}
    for _ in range(2):      # the second run finds nothing new
        assert C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"}) == {"orders": 3}
        read = C.read_snapshot(spark, snapshot, "orders")
        assert {r.name: r.v for r in read.collect()} == expected
        assert sorted(read.columns) == ["modified", "name", "v"]
        now = C.current_version(spark, snapshot, "orders")
        assert (now.version, now.upto) == (1, upto)
    land("2026-07-03", ("b", 3, t2))
    C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    read = C.read_snapshot(spark, snapshot, "orders")
    assert {r.name: r.v for r in read.collect()} == {"a": 1, "b": 3, "tie": 1}


def test_compaction_opens_files_not_taken_only(spark, tmp_dir):
    from ledgerline.sources import compaction as C

    landing, snapshot, land = _orders_landing(spark, tmp_dir)
    land("2026-07-01", *[(f"a{i}", 1, None) for i in range(50)])
    C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    land("2026-07-02", ("b", 1, None))
    now = C.current_version(spark, snapshot, "orders")
    new, files = C.files_not_taken(spark, f"{landing}/taborder", snapshot, "orders", now)
    assert files and all(f.startswith("ds=2026-07-02/") for f in files)
    assert [r.name for r in new.collect()] == ["b"]
    leaf = new._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().get("numFiles").get().value() == len(files)


def test_late_pull_without_modified_does_not_replace_a_newer_one(spark, tmp_dir):
    from ledgerline.sources import compaction as C

    landing, snapshot, tables = f"{tmp_dir}/landing", f"{tmp_dir}/snapshot", {"company": "tabCompany"}

    def land(ds, *names):
        X.write_parquet(spark.createDataFrame([(n,) for n in names], "name string"),
                        X.landing_path(landing, "tabCompany", ds))

    land("2026-07-02", "NEW")
    C.compact_landing(spark, landing, snapshot, tables)
    land("2026-07-01", "OLD", "OLDER")
    upto = C.current_version(spark, snapshot, "company").upto
    _set_landing_time(X.landing_path(landing, "tabCompany", "2026-07-01"), upto.timestamp() - 3600)
    assert C.compact_landing(spark, landing, snapshot, tables) == {"company": 1}
    assert [r.name for r in C.read_snapshot(spark, snapshot, "company").collect()] == ["NEW"]
    land("2026-07-03", "NEW", "NEWER")
    assert C.compact_landing(spark, landing, snapshot, tables) == {"company": 2}


def test_failed_compaction_leaves_the_old_snapshot(spark, tmp_dir, monkeypatch):
    from ledgerline.sources import compaction as C

    landing, snapshot, land = _orders_landing(spark, tmp_dir)
    land("2026-07-01", ("a", 1, None))
    C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    land("2026-07-02", ("a", 2, None), ("b", 2, None))

    def broken(df, path, **kw):
        df.limit(1).write.mode("overwrite").parquet(path)
        raise RuntimeError("lost")

    monkeypatch.setattr(C, "write_parquet", broken)
    with pytest.raises(RuntimeError):
        C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    read = lambda: {r.name: r.v for r in C.read_snapshot(spark, snapshot, "orders").collect()}
    assert read() == {"a": 1}
    monkeypatch.undo()
    C.compact_landing(spark, landing, snapshot, {"orders": "tabOrder"})
    assert read() == {"a": 2, "b": 2}


def test_shared_folder_is_required_on_a_cluster():
    from ledgerline.session import shared_dir

    class Conf(dict):
        def get(self, k, d=None):
            return dict.get(self, k, d)

    class Context:
        master = "yarn"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared_dir(Session())
    Session.conf = Conf({"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_dir(Session()) == "hdfs:///shared"


def test_a_table_is_dealt_before_its_rows_are_made(spark):
    """Landing moves an order once, not each of its ledger entries."""
    from ledgerline.sources.testbed import ErpTables

    for name in ("gl_entry", "sales_order", "sales_invoice", "journal_entry", "payment_entry", "purchase_invoice",
                 "sales_order_item", "sales_team"):
        plain, dealt = (getattr(ErpTables(spark, SF_SMALL, dealt), name) for dealt in (False, True))
        assert dealt.columns == plain.columns
        assert dealt.exceptAll(plain).isEmpty() and dealt.count() == plain.count()
    plan = ErpTables(spark, SF_SMALL, dealt=True).gl_entry._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate inline") < plan.index("rangepartitioning")
    days = [[r[0] for r in part] for part in ErpTables(spark, SF_SMALL, dealt=True).gl_entry.select(
        "posting_date").rdd.glom().collect()]
    assert sum(days, []) == sorted(sum(days, []))


def test_a_report_lands_only_its_tables(spark):
    import os
    import tempfile

    from ledgerline.sources.testbed import ERP_TABLES, ErpTables, LandedTables

    root = tempfile.mkdtemp(prefix="ledgerline-t-")
    t = LandedTables(spark, root, ErpTables(spark, SF_SMALL))
    assert t.sales_invoice.count() > 0
    assert [n for n in ERP_TABLES if os.path.isdir(f"{root}/{n}")] == ["sales_invoice"]
