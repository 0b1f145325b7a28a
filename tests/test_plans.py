"""Plan shape: pushdown, pruning, aggregation before joins, no global windows."""

import pytest

import __spark_entry__ as E
from conftest import SF_MID
from ledgerline.plans import finance, purchase, sales
from ledgerline.sources.testbed import landed_testbed


@pytest.fixture(scope="module")
def t(spark):
    return landed_testbed(spark, SF_MID)


def _final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_month_filter_reaches_the_scan(t):
    df = sales.target_tracker(t.sales_invoice, E.AS_OF, E.MONTHLY_TARGET)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(posting_date,2001-07-01)" in plan
    assert "LessThanOrEqual(posting_date,2001-07-31)" in plan


def test_period_filters_reach_the_ledger_scan(t):
    df = finance.net_profit(t.gl_entry, t.account, E.START, E.END, E.COMPANY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(posting_date,2001-06-01)" in plan
    assert "ReadSchema: struct<posting_date:date,account:string,debit:decimal(18,2)," \
           "credit:decimal(18,2),is_cancelled:int>" in plan


def test_share_of_total_has_no_single_partition_window(t):
    df = sales.customer_contribution(t.sales_invoice, E.START, E.END)
    plan = _final_plan(df)
    assert "Window" not in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "Subquery" in plan


def test_dimension_lookups_broadcast_and_ledger_aggregates_first(t):
    df = finance.supplier_balances(t.gl_entry, t.account, t.supplier)
    plan = _final_plan(df)
    assert "SortMergeJoin" not in plan
    # one shuffle on the party key carries partial sums, not ledger rows
    assert plan.count("partial_sum") == 2


def test_ap_ageing_reads_each_source_once(t):
    plan = _final_plan(finance.ap_ageing(t, E.AS_OF))
    for table in ("journal_entry_account", "purchase_invoice", "payment_entry_reference"):
        scans = [line for line in plan.splitlines()
                 if "FileScan parquet" in line and f"/{table}]" in line]
        assert len(scans) == 1, table


def _scans(plan, table):
    return [line for line in plan.splitlines()
            if "FileScan parquet" in line and f"/{table}]" in line]


def test_cash_flow_reads_the_ledger_once(t):
    plan = _final_plan(finance.cash_flow(t, **E._cash_flow_args()))
    assert len(_scans(plan, "gl_entry")) == 1


@pytest.mark.parametrize("name", ["ap_ageing", "cash_flow", "customer_contribution",
                                  "calendar_target_tracker", "delivery_targets",
                                  "item_sales_report", "net_profit"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    from conftest import SF_SMALL

    plan = _final_plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


# ---------------------------------------------------------------------------
# Plans at a size where nothing is broadcast
# ---------------------------------------------------------------------------

@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def _static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges_over(plan, table):
    """Exchanges above the scan of ``table``, outermost first (from the tree's
    indentation)."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and f"/{table}]" in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        d = len(line) - len(line.lstrip(" :+-"))
        if d < depth:
            depth = d
            if line.lstrip(" :+-").startswith("Exchange"):
                found.insert(0, line.strip(" :+-"))
    return found


def test_item_report_shuffles_lines_twice(t, no_broadcast):
    plan = _static_plan(sales.item_sales_report(t, start=E.ITEMS_FROM))
    over = _exchanges_over(plan, "sales_invoice_item")
    assert len([x for x in over if "rangepartitioning" not in x]) == 2, over
    assert len(_scans(plan, "sales_invoice")) == 1
    assert "coalesce(delivery_note" in plan


def test_delivery_report_reads_orders_once(t, no_broadcast):
    lines = sales.open_order_lines(t, E.AS_OF, 7, E.TAXED_TEMPLATE)
    plan = _static_plan(lines)
    assert len(_scans(plan, "sales_order")) == 1
    assert len(_exchanges_over(plan, "sales_order_item")) == 1


@pytest.mark.parametrize("report", ["receipts_by_account", "cash_flow", "anti_counterparty"])
def test_counterparty_joins_meet_sums(spark, t, no_broadcast, report):
    df = E.queries()[report](spark, SF_MID)
    plan = _static_plan(df)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "/gl_entry]" in line)
    join = next(i for i, line in enumerate(lines) if "Join [against" in line)
    between = "\n".join(lines[join:scan])
    assert "partial_sum" in between
    assert "isnotnull(against" in plan


def test_detail_and_total_in_two_exchanges(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators.aggregates import detail_and_total
    rows = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), "id")
    detail = rows.groupBy("k").agg(F.sum("id").alias("v"))
    plan = _static_plan(detail_and_total(detail, ["k"], ["v"], {"k": F.lit("TOTAL")}))
    assert plan.count("Exchange ") == 2 and plan.count("Expand ") == 1


@pytest.mark.parametrize("plan_of,dimension,headers", [
    (lambda t: finance.supplier_journal_lines(t.journal_entry_account, t.journal_entry, t.account),
     "account", "journal_entry"),
    (lambda t: purchase.purchased_lines(t), "item", "purchase_invoice")])
def test_selective_dimension_is_joined_first(t, no_broadcast, plan_of, dimension, headers):
    plan = _static_plan(plan_of(t)).splitlines()

    def depth(table):
        line = next(x for x in plan if "FileScan parquet" in x and f"/{table}]" in x)
        return len(line) - len(line.lstrip(" :+-"))
    assert depth(dimension) > depth(headers)


def test_sorted_reports_are_in_order(spark):
    balance = [r.Balance for r in E.queries()["ap_ageing"](spark, SF_MID).collect()]
    assert balance == sorted(balance, reverse=True)
    days = [r.posting_date for r in E.queries()["daily_sales"](spark, SF_MID).collect()]
    assert days == sorted(days)
