"""

Every query derives the ERP tables from the test tables of ``sf_dir`` (see
``ledgerline.sources.testbed``) and runs one report or operator over the
whole tables. Parameters are the test-bed values of FIXTURES.md §4.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

# The package and the oracle live next to this file; make them importable
# whatever the caller's working directory is.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.columns import first_non_blank, load_ladder, load_rung, week_sunday
from ledgerline.operators import key_filter, quality
from ledgerline.operators.aggregates import detail_and_total, latest_per_key
from ledgerline.operators.calendar import calendar_of
from ledgerline.operators.hot_keys import lookup_spread
from ledgerline.operators.prefix import running_totals
from ledgerline.operators.relational import exists_in, missing_from
from ledgerline.plans import finance, incremental, models, purchase, sales
from ledgerline.session import scratch_path
from ledgerline.sources.compaction import (compact_landing, compact_table, read_snapshot,
                                           rows_of_keys)
from ledgerline.sources.deletions import drop_deleted
from ledgerline.sources.extract import (ParquetSource, extract_query_to_landing, extract_to_landing,
                                        landing_path, write_parquet)
from ledgerline.sources.marks import pull_increment
from ledgerline.sources.splits import plan_splits
from ledgerline.sources.testbed import ErpTables, landed_testbed
from ledgerline.streaming.increments import (current_rows, pull_to_folder, stream_increments,
                                             with_modified)

# The training-data operators are an optional subpackage; everything else
# works without it and without the pipeline at the repository top.
try:
    import corpus_pipeline
    from ledgerline.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "ledgerline.llm", "ledgerline.llm.queries"):
        raise
    llm_queries = None

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"

# Test-bed parameters (FIXTURES.md §4).
AS_OF = dt.date(2001, 7, 15)
START = dt.date(2001, 6, 1)
END = dt.date(2001, 6, 30)
ITEMS_FROM = dt.date(2001, 1, 1)
MONTHLY_TARGET = 135_000_000
PARTY = "CUST-7"
EXCLUDED_ACCOUNTS = ("ACC-22",)
EXCLUDED_COUNTERPARTIES = ("ACC-1",)
PAYROLL_PARENT = "2500 - Payroll Liabilities"
TAXED_TEMPLATE = "VAT16"
COMPANY = "MAIN"
LOAD_TIME = "2001-07-15 00:00:00"
EXTRACT_FROM = "1998-01-01 00:00:00"


def _t(spark: SparkSession, sf_dir: str):
    """ERP tables of ``sf_dir``, landed once per application (see testbed)."""
    return landed_testbed(spark, sf_dir)


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ErpTables(spark, sf_dir).raw(name)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: accounts-payable ageing on the sf0.001 test tables."""
    return finance.ap_ageing(_t(spark, FLAGSHIP_SF_DIR), AS_OF)


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------

def _cash_flow_args() -> dict:
    return dict(start=START, end=END, excluded_accounts=EXCLUDED_ACCOUNTS,
                excluded_counterparties=EXCLUDED_COUNTERPARTIES, payroll_parent=PAYROLL_PARENT)


def _sales_invoice_load(s: SparkSession, d: str) -> DataFrame:
    """The loaded table read back; money shown as double like every report."""
    loaded = models.sales_invoice_load(_t(s, d).sales_invoice,
                                       scratch_path(s, "sales_invoice_target"), AS_OF, "daily")
    return _doubles(loaded)


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


def _invoice_load_twice(s: SparkSession, d: str) -> DataFrame:
    """Two different loads of one day into one target, the second run twice."""
    si, target = _t(s, d).sales_invoice, scratch_path(s, "sales_invoice_target")
    submitted = F.col("docstatus") == 1
    models.sales_invoice_load(si.where(submitted), target, AS_OF, "submitted")
    for _ in range(2):
        loaded = models.sales_invoice_load(si.where(~submitted), target, AS_OF, "drafts")
    return _doubles(loaded)


def _report_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def gl3(f):
        return lambda s, d: f(_t(s, d).gl_entry, _t(s, d).account, _t(s, d).supplier)

    return {
        "supplier_total_owed": gl3(finance.supplier_total_owed),
        "supplier_balances": gl3(finance.supplier_balances),
        "ap_ageing": lambda s, d: finance.ap_ageing(_t(s, d), AS_OF),
        "party_balance": lambda s, d: finance.party_balance(_t(s, d).gl_entry, PARTY),
        "receipts_by_account": lambda s, d: finance.receipts_by_account(
            _t(s, d).gl_entry, _t(s, d).account, _t(s, d).customer, START, END, EXCLUDED_ACCOUNTS),
        "receipts_detail": lambda s, d: finance.receipts_detail(
            _t(s, d).gl_entry, _t(s, d).account, _t(s, d).customer, START, END, EXCLUDED_ACCOUNTS),
        "supplier_payments": lambda s, d: finance.supplier_payments(
            _t(s, d).gl_entry, _t(s, d).account, _t(s, d).supplier, START, END, EXCLUDED_ACCOUNTS),
        "cash_flow": lambda s, d: finance.cash_flow(_t(s, d), **_cash_flow_args()),
        "cash_flow_totals": lambda s, d: finance.cash_flow_totals(_t(s, d), **_cash_flow_args()),
        "net_profit": lambda s, d: finance.net_profit(
            _t(s, d).gl_entry, _t(s, d).account, START, END, COMPANY),
        "income_expense_by_parent": lambda s, d: finance.income_expense_by_parent(
            _t(s, d).gl_entry, _t(s, d).account, START, END, COMPANY),
        "daily_sales": lambda s, d: sales.daily_sales(_t(s, d).sales_invoice),
        "customer_contribution": lambda s, d: sales.customer_contribution(
            _t(s, d).sales_invoice, START, END),
        "weekly_sales": lambda s, d: sales.weekly_sales(_t(s, d).sales_invoice),
        "item_sales_report": lambda s, d: sales.item_sales_report(_t(s, d), start=ITEMS_FROM),
        "delivery_targets": lambda s, d: sales.delivery_targets(
            _t(s, d), AS_OF, TAXED_TEMPLATE, MONTHLY_TARGET),
        "target_tracker": lambda s, d: sales.target_tracker(
            _t(s, d).sales_invoice, AS_OF, MONTHLY_TARGET),
        "calendar_target_tracker": lambda s, d: sales.calendar_target_tracker(
            _t(s, d).sales_invoice, AS_OF, MONTHLY_TARGET),
        "delivery_targets_by_order": lambda s, d: sales.delivery_targets_by_order(
            _t(s, d), AS_OF, TAXED_TEMPLATE, MONTHLY_TARGET),
        "raw_material_purchases": lambda s, d: purchase.raw_material_purchases(_t(s, d)),
        "purchased_items": lambda s, d: purchase.purchased_items(_t(s, d)),
        "total_revenue": lambda s, d: models.total_revenue(
            _raw(s, d, "orders"), "o_totalprice", scratch_path(s, "total_revenue")),
        "sales_invoice_load": _sales_invoice_load,
        "invoice_load_twice": _invoice_load_twice,
        "count_by_key": lambda s, d: models.count_by_key(
            _raw(s, d, "lineitem"), "l_suppkey", scratch_path(s, "rows_per_key"),
            key_name="author_id"),
    }


# ---------------------------------------------------------------------------
# Operators
# ---------------------------------------------------------------------------

def _latest_per_key(s: SparkSession, d: str) -> DataFrame:
    li = _raw(s, d, "lineitem")
    return latest_per_key(li, ["l_orderkey"], ["l_shipdate", "l_linenumber"],
                          ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


def _fk_orphans(s: SparkSession, d: str) -> DataFrame:
    """Invoice lines pointing at a delivery note that does not exist."""
    t = _t(s, d)
    return quality.fk_orphans(t.sales_invoice_item, "delivery_note", t.delivery_note, "name",
                              columns=["parent", "item_code", "delivery_note"])


def _default_fill(s: SparkSession, d: str) -> DataFrame:
    stamp = F.to_timestamp_ntz(F.lit(LOAD_TIME))
    dn = _t(s, d).delivery_note
    return quality.fill_defaults(dn, {"customer_provided_vehicle": ""}, load_time=stamp,
                                 audit_columns=["created_at", "updated_at"])


def _extract(s: SparkSession, d: str, table: str, columns, where) -> DataFrame:
    path, _rows = extract_to_landing(s, ParquetSource(d), f"{table}.parquet",
                                     scratch_path(s, "landing"), ds="2001-07-15",
                                     columns=columns, where=where)
    return s.read.parquet(path)


def _load_ladder(s: SparkSession, d: str) -> DataFrame:
    """Open order lines per truck-load rule; 0 where no rule fires."""
    t = _t(s, d)
    remaining = F.col("qty") - F.col("delivered_qty")
    lines = t.sales_order_item.where(remaining > 0).join(
        t.sales_order.select(F.col("name").alias("__so"), "currency"),
        F.col("parent") == F.col("__so"))
    bags = load_ladder(remaining, "weight_per_unit", "currency")
    return lines.groupBy(load_rung(remaining, "weight_per_unit", "currency").alias("rung")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(bags).cast("double").alias("total_bags"),
        F.sum(F.col("weight_per_unit") * bags).cast("double").alias("total_tonnes"))


def _anti_counterparty(s: SparkSession, d: str) -> DataFrame:
    """Paid amounts per counterparty that is no named supplier; summed first,
    so a hot counterparty is one row where it is looked up."""
    t = _t(s, d)
    gl = t.gl_entry.where((F.col("is_cancelled") == 0) & (F.col("credit") > 0)
                          & F.col("against").isNotNull())
    gl = exists_in(gl, t.account.where(F.col("account_type").isin("Bank", "Cash")),
                   "account", "name")
    sums = gl.groupBy("against").agg(F.sum("credit").cast("double").alias("amount"))
    return missing_from(sums, t.supplier, "against", "name", require="supplier_name")


def _detail_with_total(s: SparkSession, d: str) -> DataFrame:
    """Submitted sales per invoice status plus a grand-total row."""
    si = _t(s, d).sales_invoice.where(F.col("docstatus") == 1)
    detail = si.groupBy("status").agg(F.sum("base_grand_total").alias("total"))
    both = detail_and_total(detail, ["status"], ["total"], {"status": F.lit("TOTAL")})
    return both.select("status", F.col("total").cast("double").alias("total"))


def _incremental_merge(s: SparkSession, d: str) -> DataFrame:
    """Two overlapping high-water-mark pulls of ``orders`` streamed into an
    append-only history; the newest version per key is read back.

    The first pull holds other prices: with the same ``modified`` as the
    second (which wins as the newer pull) or with an earlier one."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]
    orders = with_modified(_raw(s, d, "orders").select(*cols), "o_orderdate")
    pulls, history = scratch_path(s, "pulls"), scratch_path(s, "history")
    day, kind = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 3
    stale = orders.withColumns({
        "o_totalprice": F.col("o_totalprice") + kind,
        "modified": F.when(kind == 2, F.col("modified") - F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("modified"))})
    pull_to_folder(stale.where(day < F.lit(dt.date(1998, 1, 1))), pulls, "1998-01-01")
    pull_to_folder(orders.where(day >= F.lit(dt.date(1997, 6, 1))), pulls, "2001-08-02")
    query = stream_increments(s, pulls, orders.schema, history)
    query.awaitTermination()
    return current_rows(s, history, ["o_orderkey"]).select(*cols)


def _compacted_snapshot(s: SparkSession, d: str) -> DataFrame:
    """Three pulls of ``orders`` (dated, manual, dated) compacted in two runs:
    ties and missing ``modified``, a manual run between dated pulls."""
    orders, key = _raw(s, d, "orders"), F.col("o_orderkey")
    landing, snapshot = scratch_path(s, "landing"), scratch_path(s, "snapshot")

    def land(ds, plus: int, every: int, unstamped: int) -> None:
        stamp = F.when(key % unstamped != 0, F.col("o_orderdate")).cast("timestamp_ntz")
        pull = orders.where(key % every == 0).select(
            key.alias("name"), (F.col("o_totalprice") + plus).alias("price"), stamp.alias("modified"))
        write_parquet(pull, landing_path(landing, "tabOrder", ds))

    land("2001-07-01", 0, 1, 7)
    land(None, 5, 5, 7)
    compact_landing(s, landing, snapshot, {"orders": "tabOrder"})
    land("2001-07-31", 9, 4, 8)
    compact_landing(s, landing, snapshot, {"orders": "tabOrder"})
    return read_snapshot(s, snapshot, "orders")


def _order_rows(orders: DataFrame, plus: int = 0) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("name"), (F.col("o_totalprice") + plus).alias("price"),
                         F.col("o_orderdate").cast("timestamp_ntz").alias("modified"))


def _marked_pulls(s: SparkSession, d: str) -> DataFrame:
    """Three pulls of a growing order table, each from the mark of the one
    before; the second dies before its mark (its landed rows stay)."""
    orders, key, day = _raw(s, d, "orders"), F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    landing, snapshot = scratch_path(s, "landing"), scratch_path(s, "snapshot")
    first, second = dt.date(1996, 1, 1), dt.date(1998, 6, 1)
    moved = _order_rows(orders.where((day < F.lit(first)) & (key % 10 == 0)), 7).withColumn(
        "modified", F.lit(dt.datetime(1998, 6, 1, 8)).cast("timestamp_ntz"))
    states = [_order_rows(orders.where(day < F.lit(first)), 3).withColumn(
                  "price", F.col("price") - F.when(F.col("name") % 10 != 0, 3).otherwise(0)),
              _order_rows(orders.where(day < F.lit(second)), 0),
              _order_rows(orders.where((day >= F.lit(first)) | (key % 10 != 0))).unionByName(moved)]
    for i, (state, began) in enumerate(zip(states, (first, second, dt.date(2001, 8, 2)))):
        source = ParquetSource(scratch_path(s, "source"))
        write_parquet(state, source.path("tabOrder"))
        if i == 1:      # landed, but never marked
            extract_to_landing(s, source, "tabOrder", landing, ds="pull1",
                               where=F.col("modified") >= F.lit(first))
        else:
            pull_increment(s, source, "tabOrder", landing, f"pull{i}",
                           began=dt.datetime.combine(began, dt.time()))
    compact_table(s, landing, snapshot, "orders", "tabOrder")
    return read_snapshot(s, snapshot, "orders")


def _split_query_extract(s: SparkSession, d: str) -> DataFrame:
    """A report-shaped query landed in twelve parts of equal row count."""
    _raw(s, d, "lineitem").createOrReplaceTempView("pulled_lineitem")
    query = ("SELECT l_suppkey, l_returnflag, COUNT(*) AS n_lines, MAX(l_shipdate) AS last_ship "
             "FROM pulled_lineitem WHERE l_quantity > :least GROUP BY l_suppkey, l_returnflag")
    path, _rows = extract_query_to_landing(s, None, query, scratch_path(s, "query"), {"least": 10},
                                           split_by=["l_returnflag", "l_suppkey"], splits=12)
    return s.read.parquet(path)


def _planned_splits(s: SparkSession, d: str) -> DataFrame:
    """Rows of ``orders`` by the parts of a plan over a text and a number:
    every row is in exactly one part."""
    orders = _raw(s, d, "orders")
    orders.createOrReplaceTempView("pulled_orders")
    parts = plan_splits(s, None, "pulled_orders", ["o_orderpriority", "o_orderkey"], 16)
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in parts), F.lit(0))
    return orders.select("o_orderkey", "o_orderpriority", hits.cast("int").alias("n_parts"))


def _deleted_rows(s: SparkSession, d: str) -> DataFrame:
    """Orders that are gone from the source leave the snapshot."""
    orders = _raw(s, d, "orders")
    landing, snapshot = scratch_path(s, "landing"), scratch_path(s, "snapshot")
    write_parquet(_order_rows(orders), landing_path(landing, "tabOrder", "2001-07-01"))
    compact_table(s, landing, snapshot, "orders", "tabOrder")
    _order_rows(orders.where(F.col("o_orderkey") % 50 != 0)).createOrReplaceTempView("orders_now")
    drop_deleted(s, None, "orders_now", snapshot, "orders")
    return read_snapshot(s, snapshot, "orders")


def _dimension_load(s: SparkSession, d: str) -> DataFrame:
    """Two loads of customers and of products; stamps tell what changed."""
    snapshot, times = scratch_path(s, "dimensions"), [dt.datetime(2001, 7, 1), dt.datetime(2001, 7, 15)]
    nation = _raw(s, d, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    customers = _raw(s, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), "country")
    products = _raw(s, d, "part").select(
        F.col("p_partkey").alias("product_sku"), F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("double").alias("unit_price"))
    key, sku = F.col("customer_id"), F.col("product_sku")
    incremental.load_dimension(s, "customers", customers.where(key % 7 != 0), snapshot, times[0])
    incremental.load_dimension(s, "products", products, snapshot, times[0])
    incremental.load_dimension(s, "customers", customers.where(key % 5 != 0).withColumn(
        "country", F.when(key % 3 == 0, F.lit(None)).otherwise(F.col("country"))), snapshot, times[1])
    incremental.load_dimension(s, "products", products.withColumn(
        "unit_price", F.when(sku % 4 == 0, F.col("unit_price") + 1).otherwise(F.col("unit_price"))),
        snapshot, times[1])

    def shown(name: str, key: str, content: str) -> DataFrame:
        return read_snapshot(s, snapshot, name).select(
            F.lit(name).alias("dimension"), F.col(key).cast("long").alias("id"),
            F.col(content).cast("string").alias("content"),
            F.date_format("created_at", "yyyy-MM-dd").alias("created"),
            F.date_format("updated_at", "yyyy-MM-dd").alias("updated"))
    return shown("customers", "customer_id", "country").unionByName(
        shown("products", "product_sku", "product_name"))


def _tracker_by_increments(s: SparkSession, d: str) -> DataFrame:
    """The sales tracker of sums that three pulls kept up: invoices change
    amount, day and status between pulls."""
    si = _t(s, d).sales_invoice.select("name", "posting_date", "base_grand_total", "docstatus")
    landing, snapshot, state = (scratch_path(s, x) for x in ("landing", "snapshot", "daily"))
    kind = F.pmod(F.xxhash64("name"), F.lit(10))
    early = si.withColumns({
        "base_grand_total": F.when(kind == 0, F.col("base_grand_total") + 5).otherwise(F.col("base_grand_total"))
        .cast("decimal(18,2)"),
        "posting_date": F.when(kind == 1, F.date_add("posting_date", 3)).otherwise(F.col("posting_date")),
        "docstatus": F.when(kind == 2, 1).when(kind == 3, 2).otherwise(F.col("docstatus"))})
    for i, pull in enumerate((early, si.where(kind.isin(0, 3)), si.where(kind.isin(1, 2, 9)))):
        stamped = pull.withColumn("modified", F.lit(dt.datetime(2001, 7, 1 + i)).cast("timestamp_ntz"))
        write_parquet(stamped, landing_path(landing, "tabSales Invoice", f"2001-07-0{1 + i}"))
        compact_landing(s, landing, snapshot, {"sales_invoice": "tabSales Invoice"})
        daily = incremental.refresh_daily_sales(s, snapshot, state)
    return sales.tracker_of_days(daily.select("posting_date", "sales_today"), AS_OF, MONTHLY_TARGET)


def _increment_checks(s: SparkSession, d: str) -> DataFrame:
    """Key checks of new order lines against filters of what is there: lines
    repeated within the increment and against the snapshot, lines without order."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    lines = _raw(s, d, "lineitem").select("l_orderkey", "l_linenumber")
    old = lines.where(key % 4 != 0).distinct().withColumn(
        "name", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    landing, snapshot = scratch_path(s, "landing"), scratch_path(s, "snapshot")
    write_parquet(old.withColumn("modified", F.lit(dt.datetime(2001, 7, 1)).cast("timestamp_ntz")),
                  landing_path(landing, "tabLine", "2001-07-01"))
    n = compact_table(s, landing, snapshot, "lines", "tabLine")
    there = read_snapshot(s, snapshot, "lines")
    held = key_filter.key_filter(there, ["name"], key_filter.filter_bits(n))
    new = lines.where((key % 4 == 0) | (line == 3)).withColumn(
        "name", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    twice = key_filter.pk_violations_of_increment(
        new, ["name"], held, lambda keys: rows_of_keys(s, snapshot, "lines", keys))
    orders = _raw(s, d, "orders").where(F.col("o_orderkey") % 6 != 0).select("o_orderkey")
    known = key_filter.key_filter(orders, ["o_orderkey"], key_filter.filter_bits(orders.count()))
    lost = key_filter.fk_orphans_of_increment(new, "l_orderkey", known, "o_orderkey",
                                              lambda keys: orders, ["name"])
    return (twice.select(F.lit("repeated").alias("check_name"), "name", "n_rows")
            .unionByName(lost.groupBy("name").agg(F.count(F.lit(1)).alias("n_rows"))
                         .withColumn("check_name", F.lit("no order"))))


def _running_totals(s: SparkSession, d: str) -> DataFrame:
    """Submitted sales of every day and customer, with the running total of all
    and of the customer."""
    si = _t(s, d).sales_invoice.where(F.col("docstatus") == 1)
    daily = si.groupBy("posting_date", "customer").agg(F.sum("base_grand_total").alias("amount"))
    all_days = running_totals(daily, ["posting_date", "customer"], "amount", "total")
    both = running_totals(all_days, ["posting_date"], "amount", "customer_total", within=["customer"])
    return both.select("posting_date", "customer", *[F.col(c).cast("double").alias(c)
                                                     for c in ("amount", "total", "customer_total")])


def _hot_key_lookup(s: SparkSession, d: str) -> DataFrame:
    """Lines per supplier name where a third of all lines is one supplier's and
    some have none."""
    supplier = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(
        F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_suppkey"))
    lines = _raw(s, d, "lineitem").select(supplier.alias("suppkey"), "l_quantity")
    named = lookup_spread(lines, _raw(s, d, "supplier"), "suppkey", "s_suppkey", ["s_name"])
    return named.groupBy("s_name").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.sum("l_quantity").cast("double").alias("quantity"))


def _landing_report(s: SparkSession, d: str) -> DataFrame:
    """Where three extracts were landed and the rows their writes counted."""
    landing, source = scratch_path(s, "landing"), ParquetSource(d)
    landed = [extract_to_landing(s, source, f"{table}.parquet", landing, ds=ds, where=where)
              for table, ds, where in (("customer", None, None),
                                       ("lineitem", "2001-07-15", F.col("l_quantity") > 25),
                                       ("orders", "2001-07-15", F.col("o_orderkey") < 0))]
    return s.createDataFrame([(path.removeprefix(landing + "/"), rows) for path, rows in landed],
                             "landed_at string, n_rows long")


def _star_schema_load(s: SparkSession, d: str) -> DataFrame:
    """Order lines inserted into the catalogue's purchase table, with the
    defaults of its columns."""
    root = scratch_path(s, "star")
    database = os.path.basename(root).replace("-", "_")
    s.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    schemas.create_tables(s, root, database)
    lines = _raw(s, d, "lineitem").join(
        _raw(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("l_partkey").cast("int").alias("product_sku"),
        (F.col("l_orderkey") % 3).cast("int").alias("channel_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_discount") != 0, F.col("l_discount").cast("double")).alias("discount"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"))
    stamped = schemas.with_defaults("purchase_history", lines, F.to_timestamp(F.lit(LOAD_TIME)))
    stamped.select(*schemas.PURCHASE_HISTORY.names).write.insertInto(f"{database}.purchase_history")
    return s.table(f"{database}.purchase_history").drop("created_at", "updated_at")


def _operator_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "latest_per_key": _latest_per_key,
        "pk_violations": lambda s, d: quality.pk_violations(
            _raw(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "fk_orphans": _fk_orphans,
        "not_null_violations": lambda s, d: quality.not_null_violations(
            _t(s, d).sales_invoice_item, ["delivery_note", "item_code", "qty"]),
        "default_fill": _default_fill,
        "incremental_extract": lambda s, d: _extract(
            s, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
            F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit(EXTRACT_FROM))),
        "column_pruned_extract": lambda s, d: _extract(
            s, d, "customer", ["c_custkey", "c_name"], None),
        "calendar": lambda s, d: calendar_of(_t(s, d).sales_invoice, "posting_date"),
        "week_number": lambda s, d: _t(s, d).sales_invoice.select(
            "posting_date", week_sunday("posting_date").alias("week_no")).distinct(),
        "first_non_blank": lambda s, d: _t(s, d).delivery_note.select(
            "name", first_non_blank("company_vehicle", "customer_provided_vehicle",
                                    "transporter_vehicle_number").alias("vehicle_number")),
        "load_ladder": _load_ladder,
        "anti_counterparty": _anti_counterparty,
        "detail_with_total": _detail_with_total,
        "incremental_merge": _incremental_merge,
        "compacted_snapshot": _compacted_snapshot,
        "landing_report": _landing_report,
        "marked_pulls": _marked_pulls,
        "planned_splits": _planned_splits,
        "split_query_extract": _split_query_extract,
        "deleted_rows": _deleted_rows,
        "dimension_load": _dimension_load,
        "tracker_by_increments": _tracker_by_increments,
        "increment_checks": _increment_checks,
        "running_totals": _running_totals,
        "hot_key_lookup": _hot_key_lookup,
        "star_schema_load": _star_schema_load,
    }


def erp_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_report_queries(), **_operator_queries()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The ERP queries, and the training-data ones where they are present."""
    if llm_queries is None:
        return erp_queries()
    return {**erp_queries(), **llm_queries.queries(), "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express (see ``oracle_sql.py``)."""
    from oracle_sql import oracle_queries

    out = dict(oracle_queries())
    if llm_queries is not None:
        out.update(llm_queries.oracle_sql())
        if corpus_pipeline.ORACLE_SQL is not None:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
