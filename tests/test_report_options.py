"""Report options and parameters on the sf0.001 test bed and micro tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerline.functions import columns as X
from ledgerline.plans import finance, purchase, sales
from ledgerline.sources.testbed import landed_testbed
from micro import tables


@pytest.fixture(scope="module")
def t(spark):
    return landed_testbed(spark, SF_SMALL)


def test_weekly_sales_with_year_splits_years(t):
    plain = sales.weekly_sales(t.sales_invoice)
    by_year = sales.weekly_sales(t.sales_invoice, with_year=True)
    assert by_year.columns == ["year_no", "week_no", "total_weekly_sales"]
    assert by_year.count() > plain.count()
    total = lambda df: df.agg(F.sum("total_weekly_sales")).first()[0]
    assert total(by_year) == pytest.approx(total(plain))


def test_party_balance_by_currency_adds_up(t):
    one = finance.party_balance(t.gl_entry, E.PARTY).first()
    split = finance.party_balance(t.gl_entry, E.PARTY, by_currency=True).collect()
    assert sum(r.balance for r in split) == pytest.approx(one.balance)
    assert one.transaction_currency == max(r.transaction_currency for r in split)


def test_item_report_filters(t):
    full = sales.item_sales_report(t, start=E.ITEMS_FROM)
    cust = full.select("customer_code").first()[0]
    some = sales.item_sales_report(t, start=E.ITEMS_FROM, end=dt.date(2001, 3, 31),
                                   customers=[cust]).collect()
    assert some and all(r.customer_code == cust for r in some)
    assert all(E.ITEMS_FROM <= r.posting_date <= dt.date(2001, 3, 31) for r in some)


def test_raw_material_filter_and_group(t):
    def qty(df):
        return df.agg(F.sum("total_quantity_purchased")).first()[0]

    everything = purchase.raw_material_purchases(t)
    recent = purchase.raw_material_purchases(
        t, where=F.col("posting_date") >= F.lit(dt.date(2000, 1, 1)))
    assert 0 < qty(recent) < qty(everything)
    assert purchase.raw_material_purchases(t, item_group="NO SUCH GROUP").count() == 0


def test_supplier_payments_parent_is_paying_accounts_parent(spark):
    tb = tables(
        spark,
        account=[dict(name="BANK", account_type="Bank", parent_account="Banks"),
                 dict(name="SUSP", account_type="Bank", parent_account="Banks")],
        supplier=[dict(name="S1", supplier_name="One")],
        gl_entry=[dict(name="a", posting_date="2001-06-02", account="BANK", against="S1",
                       debit=0, credit=5, voucher_subtype="Pay", is_cancelled=0),
                  dict(name="b", posting_date="2001-06-02", account="SUSP", against="S1",
                       debit=0, credit=7, voucher_subtype="Pay", is_cancelled=0)])
    rows = finance.supplier_payments(tb.gl_entry, tb.account, tb.supplier, "2001-06-01",
                                     "2001-06-30", excluded_accounts=["SUSP"]).collect()
    assert [(r.account, r.parent_account, r.supplier_name, r.credit) for r in rows] == [
        ("BANK", "Banks", "One", 5.0)]


def test_load_rung_numbers_rules(spark):
    df = spark.createDataFrame([(700, "0.025", "USD"), (480, "0.025", "KES"),
                                (400, "0.050", "KES"), (600, "0.050", "USD"),
                                (100, "0.050", "USD")],
                               "q int, w string, cur string")
    df = df.select(F.col("q").cast("decimal(12,2)").alias("q"),
                   F.col("w").cast("decimal(9,3)").alias("w"), "cur")
    got = [r[0] for r in df.select(X.load_rung("q", "w", "cur")).collect()]
    assert got == [2, 3, 4, 5, 0]


def test_literal_opening_flag_keeps_opening_entries(t):
    rows = t.sales_invoice.where((F.col("docstatus") == 1) & (F.col("posting_date") >= E.ITEMS_FROM))
    assert rows.where("is_opening = 'Yes'").count() > 0
    invoices = lambda df: df.select("sales_invoice_id").distinct().count()
    with_lines = rows.join(t.sales_invoice_item, rows["name"] == F.col("parent"), "left_semi")
    assert invoices(sales.item_sales_report(t, start=E.ITEMS_FROM)) == with_lines.where(
        "is_opening = 'No'").count()
    assert invoices(sales.item_sales_report(t, start=E.ITEMS_FROM, literal_opening=True)
                    ) == with_lines.count()
