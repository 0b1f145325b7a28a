"""Report rules on hand-made tables (edges the generated data may miss)."""

import datetime as dt

import pytest

from ledgerline.plans import finance, sales
from micro import tables

AS_OF = dt.date(2001, 7, 15)


def _d(days_before):
    return (AS_OF - dt.timedelta(days=days_before)).isoformat()


def test_ageing_bucket_edges(spark):
    days = [-1, 0, 30, 31, 60, 61, 90, 91, 120, 121]
    pis = [dict(name=f"PI-{i}", supplier="S1", supplier_name="One", due_date=_d(d),
                outstanding_amount=2 ** i, party_account_currency="KES", conversion_rate=1,
                status="Unpaid", docstatus=1) for i, d in enumerate(days)]
    t = tables(spark, purchase_invoice=pis, supplier=[dict(name="S1", supplier_name="One")])
    r = finance.ap_ageing(t, AS_OF).collect()
    assert len(r) == 1
    row = r[0].asDict()
    assert row["0-30"] == 2 ** 1 + 2 ** 2
    assert row["31-60"] == 2 ** 3 + 2 ** 4
    assert row["61-90"] == 2 ** 5 + 2 ** 6
    assert row["91-120"] == 2 ** 7 + 2 ** 8
    assert row["121-Above"] == 2 ** 9
    assert row["Total_Outstanding"] == sum(2 ** i for i in range(1, 10))
    assert row["Balance"] == row["Total_Outstanding"]


def test_ageing_usd_conversion_and_payments(spark):
    t = tables(
        spark,
        supplier=[dict(name="S1", supplier_name="One"), dict(name="S2", supplier_name="Two")],
        purchase_invoice=[
            dict(name="PI-1", supplier="S1", supplier_name="One", due_date=_d(5),
                 outstanding_amount=100, party_account_currency="USD", conversion_rate=2,
                 status="Unpaid", docstatus=1),
            dict(name="PI-2", supplier="S1", supplier_name="One", due_date=_d(5),
                 outstanding_amount=999, party_account_currency="KES", conversion_rate=1,
                 status="Paid", docstatus=1)],
        payment_entry=[
            # unallocated 30 for S1; a payment-only supplier S2 must not appear
            dict(name="PE-1", payment_type="Pay", party_type="Supplier", party="S1",
                 party_name="One", base_paid_amount=50, base_total_allocated_amount=20,
                 docstatus=1),
            dict(name="PE-2", payment_type="Pay", party_type="Supplier", party="S2",
                 party_name="Two", base_paid_amount=50, base_total_allocated_amount=0,
                 docstatus=1)],
        payment_entry_reference=[
            dict(parent="PE-1", reference_doctype="Journal Entry", allocated_amount=15),
            dict(parent="PE-1", reference_doctype="Purchase Invoice", allocated_amount=5)],
    )
    rows = {r.supplier_id: r for r in finance.ap_ageing(t, AS_OF).collect()}
    assert set(rows) == {"S1"}
    assert rows["S1"]["0-30"] == 200.0
    assert rows["S1"]["Unallocated_Amount"] == 45.0
    assert rows["S1"]["Balance"] == 155.0


def test_journal_credits_count_in_total_only(spark):
    t = tables(
        spark,
        supplier=[dict(name="S1", supplier_name="One")],
        account=[dict(name="AP", account_type="Payable", root_type="Liability")],
        journal_entry=[dict(name="JE-1", docstatus=1, is_system_generated=0),
                       dict(name="JE-2", docstatus=1, is_system_generated=1)],
        journal_entry_account=[
            dict(parent="JE-1", name="a", party_type="Supplier", party="S1", account="AP",
                 debit=0, credit=70, docstatus=1),
            dict(parent="JE-1", name="b", party_type="Supplier", party="S1", account="AP",
                 debit=10, credit=0, docstatus=1),                      # unallocated debit
            dict(parent="JE-1", name="c", party_type="Supplier", party="S1", account="AP",
                 debit=5, credit=0, reference_type="Journal Entry", docstatus=1),  # allocated
            dict(parent="JE-1", name="d", party_type="Supplier", party="S1", account="AP",
                 debit=7, credit=0, reference_type="Purchase Invoice", docstatus=1),  # ignored
            dict(parent="JE-2", name="e", party_type="Supplier", party="S1", account="AP",
                 debit=0, credit=1000, docstatus=1)],                    # system generated
    )
    r = finance.ap_ageing(t, AS_OF).collect()[0]
    assert r["0-30"] == 0.0 and r["121-Above"] == 0.0
    assert r["Total_Outstanding"] == 70.0
    assert r["Unallocated_Amount"] == 15.0
    assert r["Balance"] == 55.0


def test_net_profit_null_when_one_side_absent(spark):
    acc = [dict(name="INC", root_type="Income", parent_account="P1"),
           dict(name="EXP", root_type="Expense", parent_account="P2")]

    def run(gl_rows):
        t = tables(spark, account=acc, gl_entry=gl_rows)
        return finance.net_profit(t.gl_entry, t.account, "2001-06-01", "2001-06-30", "MAIN").first()

    inc = dict(name="g1", posting_date="2001-06-05", account="INC", debit=0, credit=100,
               is_cancelled=0)
    exp = dict(name="g2", posting_date="2001-06-06", account="EXP", debit=30, credit=0,
               is_cancelled=0)
    assert run([inc]).Net_Profit is None
    assert run([exp]).Net_Profit is None
    both = run([inc, exp])
    assert both.Net_Profit == 70.0 and both.company == "MAIN" and both.Account_type == ""


def test_supplier_balances_null_party_is_its_own_group(spark):
    t = tables(
        spark,
        supplier=[dict(name="S1", supplier_name="One")],
        account=[dict(name="AP", account_type="Payable")],
        gl_entry=[dict(name="a", account="AP", party="S1", debit=0, credit=10, is_cancelled=0),
                  dict(name="b", account="AP", party=None, debit=0, credit=4, is_cancelled=0),
                  dict(name="c", account="AP", party="S9", debit=6, credit=1, is_cancelled=0),
                  dict(name="d", account="AP", party="S1", debit=0, credit=99, is_cancelled=1)])
    got = {r.party: (r.supplier_name, r.supplier_balances)
           for r in finance.supplier_balances(t.gl_entry, t.account, t.supplier).collect()}
    assert got == {"S1": ("One", 10.0), None: (None, 4.0), "S9": (None, -5.0)}
    owed = finance.supplier_total_owed(t.gl_entry, t.account, t.supplier).first()
    assert owed.total_owed == 14.0


def test_customer_contribution_excludes_opening_and_returns(spark):
    base = dict(docstatus=1, posting_date="2001-06-10", status="Unpaid", is_opening="No")
    t = tables(spark, sales_invoice=[
        {**base, "name": "1", "customer": "C1", "customer_name": "A", "base_grand_total": 30},
        {**base, "name": "2", "customer": "C2", "customer_name": "B", "base_grand_total": 10},
        {**base, "name": "3", "customer": "C2", "customer_name": "B", "base_grand_total": 500,
         "is_opening": "Yes"},
        {**base, "name": "4", "customer": "C1", "customer_name": "A", "base_grand_total": 500,
         "status": "Return"}])
    rows = sales.customer_contribution(t.sales_invoice, "2001-06-01", "2001-06-30").collect()
    assert [(r.customer, r.total_sales_per, r.percentage) for r in rows] == [
        ("C1", 30.0, 75.0), ("C2", 10.0, 25.0)]
    assert all(r.total_sales_revenue == 40.0 for r in rows)


def test_item_report_vehicle_tax_and_team_fanout(spark):
    t = tables(
        spark,
        sales_invoice=[dict(name="SI-1", customer="C1", customer_name="A", docstatus=1,
                            is_opening="No", posting_date="2001-06-01",
                            base_total_taxes_and_charges=8, total_qty=4)],
        sales_invoice_item=[dict(parent="SI-1", item_code="I1", qty=2, base_rate=10,
                                 delivery_note="DN-1")],
        delivery_note=[dict(name="DN-1", company_vehicle="", customer_provided_vehicle=None,
                            transporter_vehicle_number="TV-9")],
        sales_team=[dict(parent="C1", sales_person="P1"), dict(parent="C1", sales_person="P1"),
                    dict(parent="C2", sales_person="P2")])
    rows = sales.item_sales_report(t).collect()
    assert len(rows) == 2                      # two team rows repeat the line
    r = rows[0]
    assert r.vehicle_number == "TV-9"
    assert r.tax_per_item == 2.0 and r.rate_after_tax == 12.0 and r.amount_after_tax == 24.0
    assert len(sales.item_sales_report(t, dedupe_team=True).collect()) == 1


@pytest.mark.parametrize("as_of,days", [
    ("2001-07-01", 31), ("2001-07-15", 31), ("2001-07-31", 31), ("2024-02-29", 29)])
def test_trackers_month_edges(spark, as_of, days):
    d = dt.date.fromisoformat(as_of)
    first = d.replace(day=1)
    si = [dict(name=f"SI-{i}", docstatus=1, posting_date=(first + dt.timedelta(days=i)).isoformat(),
               base_grand_total=1000) for i in (0, 2, days - 1)]
    t = tables(spark, sales_invoice=si)
    cal = sales.calendar_target_tracker(t.sales_invoice, as_of, 3100).collect()
    assert len(cal) == days
    assert cal[-1].cumulative_sales == 3000.0
    before = [r for r in cal if r.posting_date < d]
    assert all(r.new_daily_sales_target is None for r in before)
    today = [r for r in cal if r.posting_date == d][0]
    if d.day == days:                          # no day left: target undefined
        assert today.new_daily_sales_target is None
    else:
        assert today.new_daily_sales_target is not None
    tr = sales.target_tracker(t.sales_invoice, as_of, 3100).collect()
    assert [r.posting_date.day for r in tr] == [1, 3, days]
    assert tr[-1].spread_per_day is None       # last day of the month: no day left
    assert tr[-1].cumulative_sales == cal[-1].cumulative_sales


def test_delivery_targets_summary_rows(spark):
    t = tables(
        spark,
        sales_order=[dict(name="SO-1", creation="2001-07-14", transaction_date="2001-07-14",
                          delivery_date="2001-07-28", customer_name="A", per_delivered=0,
                          status="To Deliver and Bill", currency="KES", conversion_rate=1,
                          docstatus=1)],
        sales_order_item=[dict(parent="SO-1", item_code="I1", item_name="x",
                               weight_per_unit="0.025", qty=700, delivered_qty=0, rate=10,
                               item_tax_template="VAT16"),
                          dict(parent="SO-1", item_code="SRV-001", item_name="t",
                               weight_per_unit="0.025", qty=5, delivered_qty=0, rate=10,
                               item_tax_template="VAT16")],
        sales_team=[dict(parent="SO-1", sales_person="P1")],
        company=[dict(name="MAIN")], customer=[dict(name="C1", customer_name="A")],
        sales_invoice=[dict(name="SI-1", customer="C1", company="MAIN", docstatus=1,
                            posting_date="2001-07-15", base_grand_total=123)])
    rows = {r.customer_name: r for r in sales.delivery_targets(t, AS_OF, "VAT16", 3100).collect()}
    assert set(rows) == {"A", "Potential Deliveries", "Sales Today", "Sales Target"}
    assert rows["A"].total_quantity_tonnes == 17.0 and rows["A"].total_amount == 7888.0
    assert rows["A"].sales_person == "P1"
    assert rows["Potential Deliveries"].total_amount == 7888.0
    assert rows["Potential Deliveries"].item_code == ""
    assert rows["Sales Today"].total_amount == 123.0
    assert rows["Sales Today"].total_quantity_tonnes is None
    assert rows["Sales Target"].total_amount == 100.0


def test_cash_flow_keeps_payroll_fan_out(spark):
    acc = [dict(name="BANK", account_type="Bank"),
           dict(name="PAY1", account_type="Payable", parent_account="2500 - Payroll X"),
           dict(name="PAY2", account_type="Payable", parent_account="Other Payroll")]
    gl = [dict(name=f"g{i}", posting_date="2001-06-10", account="BANK", against=a, debit=0,
               credit=c, voucher_subtype="Pay", is_cancelled=0)
          for i, (a, c) in enumerate([("S1", 100), ("S2", 10), ("S3", 1), ("X9", 7)])]
    gl.append(dict(name="r", posting_date="2001-06-11", account="BANK", against="C1", debit=50,
                   credit=0, voucher_subtype="Receive", is_cancelled=0))
    t = tables(
        spark, account=acc, gl_entry=gl,
        customer=[dict(name="C1", customer_name="Cust")],
        supplier=[dict(name=n, supplier_name=n) for n in ("S1", "S2", "S3")],
        # S1: two exact payroll rows; S2: one exact, one other payroll; S3: none
        party_account=[dict(parent="S1", account="PAY1"), dict(parent="S1", account="PAY1"),
                       dict(parent="S2", account="PAY1"), dict(parent="S2", account="PAY2")])
    rows = {(r.Cash_Flow_Category, r.account_name): r.amount
            for r in finance.cash_flow(t, "2001-06-01", "2001-06-30",
                                       payroll_parent="2500 - Payroll X").collect()}
    assert rows == {
        ("Cash From Collections", "BANK"): 50.0,
        ("Cash Outflow", "Salary Payment"): 2 * 100.0 + 10.0,
        ("Cash Outflow", "Supplier Payment"): 10.0 + 1.0,
        ("Other drawings", "X9"): 7.0,
    }


def test_cash_flow_dedupe_payroll_counts_each_payment_once(spark):
    acc = [dict(name="BANK", account_type="Bank"),
           dict(name="PAY1", account_type="Payable", parent_account="2500 - Payroll X")]
    t = tables(
        spark, account=acc,
        gl_entry=[dict(name="g", posting_date="2001-06-10", account="BANK", against="S1",
                       debit=0, credit=100, voucher_subtype="Pay", is_cancelled=0)],
        supplier=[dict(name="S1", supplier_name="S1")],
        party_account=[dict(parent="S1", account="PAY1"), dict(parent="S1", account="PAY1")])
    args = dict(start="2001-06-01", end="2001-06-30", payroll_parent="2500 - Payroll X")
    assert finance.cash_flow(t, **args).first().amount == 200.0
    assert finance.cash_flow(t, dedupe_payroll=True, **args).first().amount == 100.0


def test_by_order_totals_row_and_future_orders(spark):
    so = [dict(name=n, creation=d, transaction_date=d, delivery_date=d, customer_name="A",
               per_delivered=0, status="To Deliver and Bill", currency="KES",
               conversion_rate=1, docstatus=1)
          for n, d in (("SO-1", "2001-07-10"), ("SO-2", "2001-07-20"))]   # SO-2 after as_of
    soi = [dict(parent=p, item_code="I1", item_name="x", weight_per_unit="0.050", qty=q,
                delivered_qty=0, rate=2, item_tax_template="EXEMPT")
           for p, q in (("SO-1", 100), ("SO-2", 10))]
    t = tables(spark, sales_order=so, sales_order_item=soi, company=[dict(name="MAIN")])
    rows = {r.sales_order_id: r
            for r in sales.delivery_targets_by_order(t, AS_OF, "VAT16", 3100).collect()}
    assert rows["SO-1"].days_since_order_date == 5
    assert rows["SO-2"].days_since_order_date == -5          # future orders are kept
    assert rows["SO-1"].total_quantity_tonnes == 5.0 and rows["SO-2"].total_amount == 20.0
    tot = rows["TOTALS"]
    assert tot.order_date is None and tot.days_since_order_date is None
    assert tot.total_quantity_tonnes == 5.5 and tot.total_amount == 220.0
    assert rows["Sales Today"].total_amount is None          # no invoice today: NULL sum
    assert rows["Sales Target Today"].total_amount == 100.0


def test_share_of_a_zero_total_is_null(spark):
    base = dict(docstatus=1, posting_date="2001-06-10", status="Unpaid", is_opening="No")
    t = tables(spark, sales_invoice=[
        {**base, "name": "1", "customer": "C1", "customer_name": "A", "base_grand_total": 5},
        {**base, "name": "2", "customer": "C2", "customer_name": "B", "base_grand_total": -5}])
    rows = sales.customer_contribution(t.sales_invoice, "2001-06-01", "2001-06-30").collect()
    assert all(r.total_sales_revenue == 0.0 and r.percentage is None for r in rows)


def test_delivery_targets_without_open_orders_keep_summary_rows(spark):
    t = tables(spark, company=[dict(name="MAIN")])
    rows = {r.customer_name: r for r in sales.delivery_targets(t, AS_OF, "VAT16", 3100).collect()}
    assert set(rows) == {"Potential Deliveries", "Sales Today", "Sales Target"}
    assert rows["Potential Deliveries"].total_amount is None
    by_order = {r.sales_order_id for r in
                sales.delivery_targets_by_order(t, AS_OF, "VAT16", 3100).collect()}
    assert by_order == {"TOTALS", "Sales Today", "Sales Target Today"}
