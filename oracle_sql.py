"""Independent SQL oracle for every registered query (DuckDB dialect).

The ERP tables are the FIXTURES.md §3 views over the test tables; each query
as one list of signed facts per report, or as one number asked per key, and
add up with FILTER; they share no plan with the Spark side. Conventions: money
is summed as DECIMAL and cast to DOUBLE at the end, ratios are DOUBLE with
x / 0 = NULL, blanks in number/date columns of summary rows are NULL,
non-grouped columns are taken with max().
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------
# Parameters of the test bed (FIXTURES.md §4)
# ---------------------------------------------------------------------------
AS_OF = "DATE '2001-07-15'"
START = "DATE '2001-06-01'"
END = "DATE '2001-06-30'"
ITEMS_FROM = "DATE '2001-01-01'"
MONTHLY_TARGET = 135000000
PARTY = "'CUST-7'"
EXCLUDED_ACCOUNT = "'ACC-22'"
EXCLUDED_COUNTERPARTY = "'ACC-1'"
PAYROLL_PARENT = "'2500 - Payroll Liabilities'"
TAXED_TEMPLATE = "'VAT16'"
COMPANY = "'MAIN'"
LOAD_TIME = "TIMESTAMP '2001-07-15 00:00:00'"
EXTRACT_FROM = "TIMESTAMP '1998-01-01 00:00:00'"

# ---------------------------------------------------------------------------
# ERP views over the test tables (FIXTURES.md §3)
# ---------------------------------------------------------------------------
VIEWS: dict[str, str] = {
    "o_base": """select o_orderkey k, o_custkey ck, 'CUST-' || cast(o_custkey as string) cust,
 'SUP-' || cast((o_orderkey*7+o_custkey) % (select count(*) from supplier) as string) sup,
 cast(o_totalprice as decimal(18,2)) amt, cast(o_orderdate as date) d, o_orderstatus st,
 o_orderpriority pr, case when o_orderkey%25=0 then 1 else 0 end canc,
 case when o_orderkey%3=0 then 'USD' else 'KES' end cur from orders""",
    "erp_supplier": "select 'SUP-' || cast(s_suppkey as string) name, s_name supplier_name from supplier",
    "erp_customer": "select 'CUST-' || cast(c_custkey as string) name, c_name customer_name from customer",
    "erp_company": "select 'MAIN' name",
    "erp_item": """select 'ITM-' || cast(p_partkey as string) name, p_name item_name,
 case when p_type='ECONOMY' then 'RAW MATERIALS' else p_type end item_group from part""",
    "erp_account": """select 'ACC-' || cast(n_nationkey as string) name,
 case n_nationkey%5 when 0 then 'Payable' when 1 then 'Receivable' when 2 then 'Bank' when 3 then 'Cash' else 'Other' end account_type,
 case when n_nationkey%5=0 then 'Liability' when n_nationkey%5<4 then 'Asset' when n_nationkey%2=0 then 'Income' else 'Expense' end root_type,
 case when n_nationkey%10=0 then '2500 - Payroll Liabilities' else 'GROUP-' || cast(n_nationkey%3 as string) end parent_account, 0 is_group from nation""",
    "erp_party_account": """select 'SUP-' || cast(s_suppkey as string) parent,
 'ACC-' || cast((s_suppkey%5)*5 as string) account from supplier""",
    "erp_sales_invoice": """select 'SI-' || cast(k as string) name, cust customer, c_name customer_name, d posting_date, d+30 due_date, amt base_grand_total,
 case when st='P' then 0 else 1 end docstatus, case pr when '1-URGENT' then 'Return' when '5-LOW' then 'Paid' else 'Unpaid' end status,
 case when k%50=1 then 'Yes' else 'No' end is_opening, 'MAIN' company, 'EXP-' || cast(k%9 as string) export_series, 'ETR-' || cast(k as string) etr_invoice_number,
 case when k%3=0 then 'Export' else 'Local' end tax_category, 'TAX-' || cast(ck as string) tax_id,
 cast(case when k%4=0 then 0 else amt*0.16 end as decimal(18,2)) base_total_taxes_and_charges, cast(case when k%50=2 then 0 else k%40+1 end as decimal(18,2)) total_qty
 from o_base o join customer c on o.ck=c.c_custkey""",
    "erp_sales_invoice_item": """select 'SI-' || cast(l_orderkey as string) parent, 'ITM-' || cast(l_partkey as string) item_code, p_name item_name, cast(l_quantity as decimal(18,2)) qty,
 cast(l_extendedprice as decimal(18,2)) base_rate, cast(l_extendedprice*l_quantity as decimal(18,2)) base_amount, cast(l_quantity*0.025 as decimal(18,3)) tonnes_input,
 case when l_linenumber%3=0 then cast(null as string) else 'DN-' || cast(l_orderkey as string) end delivery_note from lineitem join part on l_partkey=p_partkey""",
    "erp_delivery_note": """select 'DN-' || cast(o_orderkey as string) name, case when o_orderkey%6=0 then 'CV-' || cast(o_orderkey%7 as string) else '' end company_vehicle,
 case when o_orderkey%4=0 then 'PV-' || cast(o_orderkey%5 as string) else cast(null as string) end customer_provided_vehicle, case when o_orderkey%10=2 then 'TV-1' else '' end transporter_vehicle_number from orders where o_orderkey%2=0""",
    "erp_sales_team": """select 'CUST-' || cast(c_custkey as string) parent, 'SP-' || cast(c_nationkey as string) sales_person from customer where c_custkey%3<>0
 union all select 'CUST-' || cast(c_custkey as string), 'SP-X' from customer where c_custkey%10=1
 union all select 'SO-' || cast(o_orderkey as string), 'SP-' || cast(o_custkey%25 as string) from orders where o_orderkey%4<>0
 union all select 'SO-' || cast(o_orderkey as string), 'SP-X' from orders where o_orderkey%9=1""",
    "erp_sales_order": """select 'SO-' || cast(k as string) name, d creation, d transaction_date, d+14 delivery_date, c_name customer_name, cast(k%100 as int) per_delivered, cast(k%90 as int) per_billed,
 case pr when '5-LOW' then 'Completed' when '4-NOT SPECIFIED' then 'On Hold' else 'To Deliver and Bill' end status, cur currency, cast(case when cur='USD' then 129.5 else 1 end as decimal(9,4)) conversion_rate,
 case when st='P' then 0 else 1 end docstatus from o_base o join customer c on o.ck=c.c_custkey""",
    "erp_sales_order_item": """select 'SO-' || cast(l_orderkey as string) parent, case when l_partkey%20=0 then 'SRV-001' else 'ITM-' || cast(l_partkey as string) end item_code, p_name item_name,
 cast(case when l_partkey%2=0 then 0.025 else 0.05 end as decimal(9,3)) weight_per_unit, cast(l_quantity*20 as decimal(12,2)) qty, cast(case when l_linenumber=7 then l_quantity*20 when l_linenumber=6 then 10 else 0 end as decimal(12,2)) delivered_qty,
 cast(l_extendedprice as decimal(12,2)) rate, case when l_returnflag='A' then 'VAT16' else 'EXEMPT' end item_tax_template from lineitem join part on l_partkey=p_partkey""",
    "erp_purchase_invoice": """select 'PI-' || cast(k as string) name, sup supplier, s_name supplier_name, d posting_date, d+30 due_date, amt base_grand_total, cast(case when substr(sup,length(sup),1) in ('3','7') then amt*0.1 else amt end as decimal(18,2)) outstanding_amount, cur party_account_currency,
 cast(case when cur='USD' then 1.25 else 1 end as decimal(9,4)) conversion_rate, case k%5 when 0 then 'Paid' when 1 then 'Return' else 'Unpaid' end status, case when k%5=1 then 1 else 0 end is_return, case when st='P' then 0 else 1 end docstatus
 from o_base o join supplier s on o.sup='SUP-' || cast(s.s_suppkey as string)""",
    "erp_purchase_invoice_item": """select 'PI-' || cast(l_orderkey as string) parent, 'ITM-' || cast(l_partkey as string) item_code, p_name item_name, p_type item_group, cast(l_quantity as decimal(18,2)) qty, cast(l_extendedprice as decimal(18,2)) rate,
 case when l_linenumber%2=0 then 'BAG' else 'KG' end uom from lineitem join part on l_partkey=p_partkey""",
    "erp_journal_entry": """select 'JE-' || cast(o_orderkey as string) name, cast(o_orderdate as date) posting_date, case when o_orderstatus='P' then 0 else 1 end docstatus, case when o_orderkey%8=0 then 1 else 0 end is_system_generated from orders where o_orderkey%4<2""",
    "erp_journal_entry_account": """select 'JE-' || cast(l_orderkey as string) parent, 'JEA-' || cast(l_orderkey as string) || '-' || cast(l_partkey as string) name, case when l_partkey%6=0 then 'Customer' else 'Supplier' end party_type, 'SUP-' || cast(l_suppkey as string) party,
 'ACC-' || cast(l_partkey%25 as string) account, cast(case when l_linenumber in (3,4,5) then l_extendedprice else 0 end as decimal(18,2)) debit, cast(case when l_linenumber in (1,2) then l_extendedprice else 0 end as decimal(18,2)) credit,
 case when l_linenumber=4 then 'Journal Entry' when l_linenumber=5 then 'Purchase Invoice' else cast(null as string) end reference_type, case when l_linenumber in (2,4,5) and l_partkey%3=0 then 'REF' else cast(null as string) end reference_name, 1 docstatus from lineitem""",
    "erp_payment_entry": """select 'PE-' || cast(k as string) name, case when k%3=0 then 'Receive' else 'Pay' end payment_type, d posting_date, case when k%7=0 then 'Customer' else 'Supplier' end party_type, sup party, s_name party_name, amt base_paid_amount,
 cast(case when k%4=0 then amt else amt*0.5 end as decimal(18,2)) base_total_allocated_amount, case when st='P' then 0 else 1 end docstatus from o_base o join supplier s on o.sup='SUP-' || cast(s.s_suppkey as string)""",
    "erp_payment_entry_reference": """select 'PE-' || cast(l_orderkey as string) parent, case when l_returnflag='A' then 'Journal Entry' else 'Purchase Invoice' end reference_doctype, cast(l_extendedprice as decimal(18,2)) allocated_amount from lineitem""",
    "erp_gl_entry": """select *, name voucher_no, cast(null as string) against_voucher_type, cast(null as string) against_voucher,
 debit debit_in_transaction_currency, credit credit_in_transaction_currency from (
 select 'A-' || cast(k as string) name, d posting_date, 'ACC-' || cast((k%5)*5 as string) account, 'Supplier' party_type, sup party, cast(0 as decimal(18,2)) debit, cast(amt as decimal(18,2)) credit, cast(null as string) against, 'Purchase Invoice' voucher_type, 'Purchase Invoice' voucher_subtype, cur transaction_currency, canc is_cancelled from o_base o where 1=1
 union all select 'B-' || cast(k as string) name, d posting_date, 'ACC-' || cast((k%5)*5 as string) account, 'Supplier' party_type, sup party, cast(case when substr(sup,length(sup),1)='7' then amt*2 else amt*0.5 end as decimal(18,2)) debit, cast(0 as decimal(18,2)) credit, cast(null as string) against, 'Payment Entry' voucher_type, 'Pay' voucher_subtype, cur transaction_currency, canc is_cancelled from o_base o where k%20<>3
 union all select 'C-' || cast(k as string) name, d posting_date, case when k%2=0 then 'ACC-2' else 'ACC-3' end account, 'Customer' party_type, cust party, cast(amt as decimal(18,2)) debit, cast(0 as decimal(18,2)) credit, cust against, 'Payment Entry' voucher_type, case k%4 when 0 then 'Journal Entry' when 2 then 'Internal Transfer' else 'Receive' end voucher_subtype, cur transaction_currency, canc is_cancelled from o_base o where 1=1
 union all select 'D-' || cast(k as string) name, d posting_date, case when k%2=0 then 'ACC-7' else 'ACC-8' end account, 'Supplier' party_type, sup party, cast(0 as decimal(18,2)) debit, cast(amt*0.8 as decimal(18,2)) credit, sup against, 'Payment Entry' voucher_type, case k%4 when 0 then 'Journal Entry' when 2 then 'Internal Transfer' else 'Pay' end voucher_subtype, cur transaction_currency, canc is_cancelled from o_base o where k%7<>0
 union all select 'E-' || cast(k as string) name, d posting_date, case when k%5=1 then 'ACC-22' else 'ACC-12' end account, cast(null as string) party_type, cast(null as string) party, cast(0 as decimal(18,2)) debit, cast(amt as decimal(18,2)) credit, case when k%11=0 then cast(null as string) else 'ACC-' || cast(k%25 as string) end against, 'Journal Entry' voucher_type, case when k%6=0 then 'Internal Transfer' else 'Journal Entry' end voucher_subtype, cur transaction_currency, canc is_cancelled from o_base o where k%3=1
 union all select 'F-' || cast(k as string) name, d posting_date, case k%3 when 0 then 'ACC-4' when 1 then 'ACC-14' else 'ACC-24' end account, cast(null as string) party_type, cast(null as string) party, cast(0 as decimal(18,2)) debit, cast(amt as decimal(18,2)) credit, cast(null as string) against, 'Sales Invoice' voucher_type, 'Sales Invoice' voucher_subtype, cur transaction_currency, canc is_cancelled from o_base o where 1=1
 union all select 'G-' || cast(k as string) name, d posting_date, case k%2 when 0 then 'ACC-9' else 'ACC-19' end account, cast(null as string) party_type, cast(null as string) party, cast(amt*0.6 as decimal(18,2)) debit, cast(0 as decimal(18,2)) credit, cast(null as string) against, 'Purchase Invoice' voucher_type, 'Purchase Invoice' voucher_subtype, cur transaction_currency, canc is_cancelled from o_base o where k%5<>0
 )""",
}


def with_views(body: str) -> str:
    """Prefix ``body`` (``cte AS (...), ... SELECT ...`` or a bare SELECT)
    with the views it references, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sql in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(sql)
                if name not in needed:
                    needed.append(name)

    visit(body)
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in needed)
    stripped = body.lstrip()
    if not needed:
        return stripped if stripped.upper().startswith("SELECT") else f"WITH {stripped}"
    if stripped.upper().startswith("SELECT"):
        return f"WITH {ctes}\n{stripped}"
    return f"WITH {ctes},\n{stripped}"


# ---------------------------------------------------------------------------
# Finance: one list of facts per report, added up with FILTER
# ---------------------------------------------------------------------------
def _kind(account: str, *kinds: str) -> str:
    """The account exists and has one of the kinds."""
    listed = ", ".join(f"'{k}'" for k in kinds)
    return f"{account} IN (SELECT name FROM erp_account WHERE account_type IN ({listed}))"


_OWED = f"""
owed AS (
  SELECT party, sum(credit) - sum(debit) AS net FROM erp_gl_entry
  WHERE is_cancelled = 0 AND {_kind('account', 'Payable')}
  GROUP BY party)
"""

SUPPLIER_BALANCES = _OWED + """
SELECT party, (SELECT s.supplier_name FROM erp_supplier s WHERE s.name = owed.party) AS supplier_name,
  net::DOUBLE AS supplier_balances
FROM owed
"""

SUPPLIER_TOTAL_OWED = _OWED + """
SELECT (sum(net) FILTER (net > 0))::DOUBLE AS total_owed FROM owed
"""

_AGE_BANDS = {"0-30": (0, 30), "31-60": (31, 60), "61-90": (61, 90), "91-120": (91, 120),
              "121-Above": (121, 1_000_000)}


def _ap_ageing() -> str:
    """Facts (who, what, age, amount): ``bill`` an open invoice, ``note`` a
    journal credit, ``paid`` anything that lowers the debt."""
    bands = ",\n  ".join(
        f"coalesce(sum(amount) FILTER (what = 'bill' AND age BETWEEN {lo} AND {hi}), 0)::DOUBLE"
        f' AS "{name}"' for name, (lo, hi) in _AGE_BANDS.items())
    return f"""
facts AS (
  SELECT supplier AS who, 'bill' AS what, {AS_OF} - due_date AS age, supplier_name AS label,
    (outstanding_amount * if(party_account_currency = 'USD', conversion_rate, 1))::DECIMAL(38,6) AS amount
  FROM erp_purchase_invoice
  WHERE docstatus = 1 AND due_date <= {AS_OF} AND NOT (status = 'Paid' OR status = 'Return')
  UNION ALL
  SELECT party, if(credit > 0, 'note', 'paid'), NULL,
    (SELECT s.supplier_name FROM erp_supplier s WHERE s.name = l.party AND l.credit > 0),
    if(credit > 0, credit, debit)::DECIMAL(38,6)
  FROM erp_journal_entry_account l
  WHERE party_type = 'Supplier' AND docstatus = 1 AND {_kind('account', 'Payable')}
    AND EXISTS (SELECT 1 FROM erp_journal_entry h
                WHERE h.name = l.parent AND h.docstatus = 1 AND h.is_system_generated = 0)
    AND ((credit > 0 AND coalesce(reference_type, reference_name) IS NULL)
         OR (debit > 0 AND reference_type IS DISTINCT FROM 'Purchase Invoice'))
  UNION ALL
  SELECT p.party, 'paid', NULL, NULL, moved::DECIMAL(38,6)
  FROM erp_payment_entry p,
    LATERAL (SELECT greatest(p.base_paid_amount - p.base_total_allocated_amount, 0) AS moved
             UNION ALL
             SELECT allocated_amount FROM erp_payment_entry_reference a
             WHERE a.parent = p.name AND a.reference_doctype = 'Journal Entry')
  WHERE p.docstatus = 1 AND p.payment_type = 'Pay' AND p.party_type = 'Supplier')
SELECT who AS supplier_id, max(label) AS supplier_name,
  {bands},
  coalesce(sum(amount) FILTER (what = 'paid'), 0)::DOUBLE AS Unallocated_Amount,
  (sum(amount) FILTER (what <> 'paid'))::DOUBLE AS Total_Outstanding,
  sum(if(what = 'paid', -amount, amount))::DOUBLE AS Balance
FROM facts GROUP BY who
HAVING count(*) FILTER (what <> 'paid') > 0 AND sum(if(what = 'paid', -amount, amount)) > 0
"""


AP_AGEING = _ap_ageing()

PARTY_BALANCE = f"""
SELECT party, max(transaction_currency) AS transaction_currency,
  sum(debit_in_transaction_currency - credit_in_transaction_currency)::DOUBLE AS balance
FROM erp_gl_entry WHERE is_cancelled = 0 GROUP BY party HAVING party = {PARTY}
"""

# Movements of the period on bank and cash accounts; ``flow`` is signed.
_MOVES = f"""
moves AS (
  SELECT * REPLACE (debit::DOUBLE AS debit, credit::DOUBLE AS credit),
    debit AS money_in, credit AS money_out
  FROM erp_gl_entry
  WHERE {_kind('account', 'Bank', 'Cash')} AND account <> {EXCLUDED_ACCOUNT}
    AND is_cancelled = 0 AND posting_date >= {START} AND posting_date <= {END})
"""

_RECEIVED = "voucher_subtype IN ('Receive', 'Journal Entry') AND money_in > 0"
_PAID = "voucher_subtype IN ('Pay', 'Journal Entry') AND money_out > 0"
_SHOWN = ("voucher_type, voucher_no, voucher_subtype, against_voucher_type, against_voucher")

RECEIPTS_DETAIL = _MOVES + f"""
SELECT posting_date, account, debit, credit, against, party_type, customer_name, {_SHOWN}
FROM moves, (SELECT name AS payer, customer_name FROM erp_customer)
WHERE against = payer AND {_RECEIVED}
"""

RECEIPTS_BY_ACCOUNT = _MOVES + f"""
SELECT account AS account_name, sum(money_in)::DOUBLE AS money_in FROM moves
WHERE {_RECEIVED} AND against IN (SELECT name FROM erp_customer) GROUP BY account
"""

SUPPLIER_PAYMENTS = _MOVES + f"""
SELECT posting_date, account, debit, credit, against, party_type, supplier_name,
  (SELECT parent_account FROM erp_account a WHERE a.name = moves.account) AS parent_account, {_SHOWN}
FROM moves, (SELECT name AS payee, supplier_name FROM erp_supplier)
WHERE against = payee AND {_PAID}
"""

# A payment counts once per payroll account of its supplier, by that account's
# parent, or once as a supplier payment when there is none.
_FLOWS = _MOVES + f""",
wages AS (
  SELECT p.parent AS payee, a.parent_account = {PAYROLL_PARENT} AS salary
  FROM erp_party_account p, erp_account a
  WHERE a.name = p.account AND contains(a.parent_account, 'Payroll')),
flows AS (
  SELECT 'Cash From Collections' AS Cash_Flow_Category, account AS account_name, money_in AS amount
  FROM moves WHERE {_RECEIVED} AND against IN (SELECT name FROM erp_customer)
  UNION ALL
  SELECT 'Cash Outflow', if(salary, 'Salary Payment', 'Supplier Payment'), money_out
  FROM moves, LATERAL (
    SELECT salary FROM wages w WHERE w.payee = moves.against
    UNION ALL
    SELECT false WHERE NOT EXISTS (SELECT 1 FROM wages w WHERE w.payee = moves.against))
  WHERE {_PAID} AND against IN (SELECT name FROM erp_supplier)
  UNION ALL
  SELECT 'Other drawings', against, money_out
  FROM moves
  WHERE money_out > 0 AND voucher_subtype <> 'Internal Transfer' AND against <> {EXCLUDED_COUNTERPARTY}
    AND NOT EXISTS (SELECT 1 FROM erp_supplier s
                    WHERE s.name = moves.against AND s.supplier_name IS NOT NULL))
"""

CASH_FLOW = _FLOWS + """
SELECT Cash_Flow_Category, account_name, sum(amount)::DOUBLE AS amount FROM flows GROUP BY ALL
"""

CASH_FLOW_TOTALS = _FLOWS + """
SELECT 'Balance/Deficit' AS Totals,
  coalesce(sum(amount) FILTER (Cash_Flow_Category LIKE '%Collections'), 0)::DOUBLE AS collections,
  coalesce(sum(amount) FILTER (Cash_Flow_Category LIKE '%Outflow'), 0)::DOUBLE AS Supplier_payments,
  coalesce(sum(amount) FILTER (Cash_Flow_Category LIKE '%drawings'), 0)::DOUBLE AS other_drawings
FROM flows HAVING count(*) > 0
"""

_RESULTS = f"""
results AS (
  SELECT a.parent_account, a.root_type = 'Income' AS earned, g.net
  FROM erp_account a, LATERAL (
    SELECT sum(credit - debit) AS net FROM erp_gl_entry g
    WHERE g.account = a.name AND g.is_cancelled = 0 AND g.posting_date >= {START}
      AND g.posting_date <= {END}) g
  WHERE a.root_type IN ('Expense', 'Income') AND g.net IS NOT NULL)
"""

INCOME_EXPENSE_BY_PARENT = _RESULTS + f"""
SELECT {COMPANY} AS company, parent_account, (-sum(net) FILTER (NOT earned))::DOUBLE AS total_expenses,
  (sum(net) FILTER (earned))::DOUBLE AS total_income
FROM results GROUP BY parent_account
"""

NET_PROFIT = _RESULTS + f"""
SELECT if(count(*) > 0, {COMPANY}, NULL) AS company, 'Net Profit' AS Account,
  (sum(net) FILTER (earned) + sum(net) FILTER (NOT earned))::DOUBLE AS Net_Profit, '' AS Account_type
FROM results
"""

# ---------------------------------------------------------------------------
# Sales
# ---------------------------------------------------------------------------
DAILY_SALES = """
SELECT posting_date, (sum(base_grand_total) FILTER (docstatus = 1))::DOUBLE AS TOTAL_DAILY_SALES
FROM erp_sales_invoice GROUP BY posting_date HAVING bool_or(docstatus = 1)
"""

# Days since the Sunday on or before 1 January, in whole weeks.
_WEEK = ("CAST((dayofyear(posting_date) + 6 - dayofweek(posting_date)) // 7 AS INTEGER)")

WEEKLY_SALES = f"""
SELECT {_WEEK} AS week_no, sum(base_grand_total)::DOUBLE AS total_weekly_sales
FROM erp_sales_invoice WHERE docstatus = 1 GROUP BY ALL
"""

CUSTOMER_CONTRIBUTION = f"""
counted AS (
  SELECT customer, customer_name, base_grand_total AS amount FROM erp_sales_invoice
  WHERE docstatus = 1 AND is_opening <> 'Yes' AND status <> 'Return'
    AND posting_date >= {START} AND posting_date <= {END})
SELECT customer, customer_name, sum(amount)::DOUBLE AS total_sales_per,
  (SELECT sum(amount) FROM counted)::DOUBLE AS total_sales_revenue,
  sum(amount)::DOUBLE / nullif((SELECT sum(amount) FROM counted)::DOUBLE, 0) * 100 AS percentage
FROM counted GROUP BY customer, customer_name
"""

ITEM_SALES_REPORT = f"""
sold AS (
  SELECT *, if(base_total_taxes_and_charges = 0, 0,
               base_total_taxes_and_charges::DOUBLE / nullif(total_qty::DOUBLE, 0)) AS tax
  FROM erp_sales_invoice
  WHERE posting_date >= {ITEMS_FROM} AND is_opening <> 'Yes' AND docstatus = 1),
people AS (
  SELECT c.customer, list(s.sales_person) AS persons
  FROM (SELECT DISTINCT customer FROM sold) c JOIN erp_sales_team s ON s.parent = c.customer
  GROUP BY c.customer)
SELECT v.name AS sales_invoice_id, l.delivery_note AS delivery_note_id, v.customer AS customer_code,
  v.customer_name, unnest(coalesce(p.persons, [NULL])) AS sales_person_name, v.posting_date, v.due_date,
  (SELECT coalesce(nullif(n.company_vehicle, ''), nullif(n.customer_provided_vehicle, ''),
                   nullif(n.transporter_vehicle_number, ''))
   FROM erp_delivery_note n WHERE n.name = l.delivery_note) AS vehicle_number,
  v.export_series, v.etr_invoice_number, v.tax_category, v.status, v.tax_id, l.item_code, l.item_name,
  l.qty::DOUBLE AS Quantity_in_UOM, l.tonnes_input::DOUBLE AS Qty_in_Tonnes,
  l.base_rate::DOUBLE AS rate_before_tax, l.base_amount::DOUBLE AS amount_before_tax,
  v.tax AS tax_per_item, l.base_rate::DOUBLE + v.tax AS rate_after_tax,
  (l.base_rate::DOUBLE + v.tax) * l.qty::DOUBLE AS amount_after_tax
FROM sold v JOIN erp_sales_invoice_item l ON l.parent = v.name LEFT JOIN people p USING (customer)
"""

# Fixed values: (least quantity, exact, weight, currency, bags) of a truck load.
_LOADS = ((680, False, "0.025", "KES", 680), (680, False, "0.025", "USD", 680),
          (480, True, "0.025", None, 480), (340, False, None, "KES", 340),
          (560, False, None, "USD", 560))


def _rung(q: str, weight: str, currency: str) -> str:
    """Number of the first load rule that holds, 0 if none does."""
    out = "0"
    for n, (least, exact, w, cur, _) in reversed(list(enumerate(_LOADS, 1))):
        tests = [f"{q} {'=' if exact else '>='} {least}"]
        tests += [f"{weight} = {w}"] if w else []
        tests += [f"{currency} = '{cur}'"] if cur else []
        out = f"if({' AND '.join(tests)}, {n}, {out})"
    return out


_BAGS = "[" + ", ".join(str(x[-1]) for x in _LOADS) + "]"


def _deliveries(days: int) -> str:
    return f"""
pending AS (
  SELECT o.name AS sales_order_id, o.creation::DATE AS order_date, o.delivery_date, o.customer_name,
    l.item_code, l.item_name, l.weight_per_unit, open_qty, {_rung('open_qty', 'l.weight_per_unit', 'o.currency')} AS rung,
    (if(l.item_tax_template = {TAXED_TEMPLATE}, round(l.rate * 1.16, 2), l.rate)
     * if(o.currency = 'USD', o.conversion_rate, 1))::DECIMAL(20,6) AS price,
    unnest(coalesce((SELECT list(t.sales_person) FROM erp_sales_team t WHERE t.parent = o.name), [NULL]))
      AS sales_person
  FROM erp_sales_order o
  JOIN (SELECT *, qty - delivered_qty AS open_qty FROM erp_sales_order_item) l ON l.parent = o.name
  WHERE open_qty > 0 AND l.item_code <> 'SRV-001' AND o.docstatus = 1 AND o.per_delivered <= 60
    AND o.transaction_date::DATE >= {AS_OF} - {days}
    AND NOT (o.status = 'Completed' OR o.status = 'Closed' OR o.status = 'On Hold')),
loads AS (
  SELECT * EXCLUDE (open_qty, rung, price, weight_per_unit),
    weight_per_unit * if(rung = 0, open_qty, {_BAGS}[rung]) AS tonnes,
    if(rung = 0, open_qty, {_BAGS}[rung]) * price AS amount
  FROM pending)"""


_NEWS = f"""
  SELECT 'Sales Today' AS label, (
    SELECT sum(base_grand_total) FROM erp_sales_invoice
    WHERE posting_date = {AS_OF} AND docstatus = 1 AND company IN (SELECT name FROM erp_company)
      AND customer IN (SELECT name FROM erp_customer))::DOUBLE AS total_amount
  UNION ALL
  SELECT 'TARGET', round({MONTHLY_TARGET} / 31, 4)::DECIMAL(20,4)::DOUBLE"""

DELIVERY_TARGETS = _deliveries(7) + f""",
per_item AS (
  SELECT customer_name, item_code, item_name, max(sales_person) AS sales_person,
    round(sum(tonnes), 2) AS total_quantity_tonnes, sum(amount) AS total_amount
  FROM loads GROUP BY customer_name, item_code, item_name)
SELECT * REPLACE (total_quantity_tonnes::DOUBLE AS total_quantity_tonnes, total_amount::DOUBLE AS total_amount)
FROM per_item
UNION ALL
SELECT 'Potential Deliveries', '', '', '', round(sum(total_quantity_tonnes), 2)::DOUBLE,
  sum(total_amount)::DOUBLE FROM per_item
UNION ALL
SELECT replace(label, 'TARGET', 'Sales Target'), '', '', '', NULL, total_amount FROM ({_NEWS})
"""

DELIVERY_TARGETS_BY_ORDER = _deliveries(14) + f""",
per_item AS (
  SELECT sales_order_id, max(order_date) AS order_date, max(delivery_date) AS delivery_date, customer_name,
    item_code, item_name, max(sales_person) AS sales_person,
    ({AS_OF} - max(order_date))::INTEGER AS days_since_order_date,
    round(sum(tonnes), 2) AS total_quantity_tonnes, sum(amount) AS total_amount
  FROM loads GROUP BY sales_order_id, customer_name, item_code, item_name)
SELECT * REPLACE (total_quantity_tonnes::DOUBLE AS total_quantity_tonnes, total_amount::DOUBLE AS total_amount)
FROM per_item
UNION ALL
SELECT 'TOTALS', NULL, NULL, '', '', '', '', NULL, round(sum(total_quantity_tonnes), 2)::DOUBLE,
  sum(total_amount)::DOUBLE FROM per_item
UNION ALL
SELECT replace(label, 'TARGET', 'Sales Target Today'), NULL, NULL, '', '', '', '', NULL, NULL, total_amount
FROM ({_NEWS})
"""

# The month's days; sales and target up to a day are asked for each day.
_MONTH = f"""
dates AS (
  SELECT unnest(range(date_trunc('month', {AS_OF})::DATE, last_day({AS_OF}) + 1, INTERVAL 1 DAY))::DATE AS day),
sales AS (
  SELECT posting_date AS day, sum(base_grand_total) AS amount FROM erp_sales_invoice
  WHERE docstatus = 1 AND posting_date IN (SELECT day FROM dates) GROUP BY posting_date),
goal AS (SELECT round({MONTHLY_TARGET} / (SELECT count(*) FROM dates), 4)::DECIMAL(20,4) AS per_day)
"""

TARGET_TRACKER = _MONTH + f""",
upto AS (
  SELECT s.day, s.amount, (SELECT sum(p.amount) FROM sales p WHERE p.day <= s.day) AS done,
    (SELECT count(*) FROM sales p WHERE p.day <= s.day) * (SELECT per_day FROM goal) AS wanted
  FROM sales s)
SELECT day AS posting_date, amount::DOUBLE AS sales_today, done::DOUBLE AS cumulative_sales,
  wanted::DOUBLE AS sales_target_cumulative, (wanted - done)::DOUBLE AS cumulative_deficit,
  (wanted - done)::DOUBLE / nullif((SELECT count(*) FROM dates d WHERE d.day > upto.day), 0)::DOUBLE
    AS spread_per_day
FROM upto
"""

CALENDAR_TARGET_TRACKER = _MONTH + f""",
upto AS (
  SELECT d.day, coalesce((SELECT amount FROM sales s WHERE s.day = d.day), 0) AS amount,
    coalesce((SELECT sum(p.amount) FROM sales p WHERE p.day <= d.day), 0) AS done,
    day(d.day) * (SELECT per_day FROM goal) AS wanted,
    (SELECT count(*) FROM dates p WHERE p.day > d.day) AS days_left
  FROM dates d)
SELECT day AS posting_date, amount::DOUBLE AS sales_today, done::DOUBLE AS cumulative_sales,
  (wanted - done)::DOUBLE AS cumulative_deficit,
  (wanted - done)::DOUBLE / greatest(days_left, 1)::DOUBLE AS spread_per_day,
  if(day >= {AS_OF}, (SELECT per_day FROM goal)::DOUBLE
     + (SELECT (wanted - done)::DOUBLE / nullif(days_left::DOUBLE, 0) FROM upto WHERE day = {AS_OF}), NULL)
    AS new_daily_sales_target
FROM upto
"""

# ---------------------------------------------------------------------------
# Purchases
# ---------------------------------------------------------------------------
_BOUGHT = """
bought AS (
  SELECT * FROM erp_purchase_invoice_item
  WHERE item_code IN (SELECT name FROM erp_item WHERE item_group = 'RAW MATERIALS')
    AND parent IN (SELECT name FROM erp_purchase_invoice WHERE is_return = 0 AND docstatus = 1))
"""

RAW_MATERIAL_PURCHASES = _BOUGHT + """
SELECT item_code, item_name, max(uom) AS uom, max(rate)::DOUBLE AS rate,
  sum(qty)::DOUBLE AS total_quantity_purchased
FROM bought GROUP BY item_code, item_name
"""

PURCHASED_ITEMS = _BOUGHT + """
SELECT item_code AS itm_code, item_name FROM bought GROUP BY ALL
"""

# ---------------------------------------------------------------------------
# Models
# ---------------------------------------------------------------------------
TOTAL_REVENUE = """
SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_revenue FROM orders
"""

_LOADED = f"""
  * REPLACE (upper(customer_name) AS customer_name, base_grand_total::DOUBLE AS base_grand_total,
             base_total_taxes_and_charges::DOUBLE AS base_total_taxes_and_charges,
             total_qty::DOUBLE AS total_qty), {AS_OF} AS last_updated"""

SALES_INVOICE_LOAD = f"""
SELECT {_LOADED}, 'daily' AS load_id FROM erp_sales_invoice
"""

INVOICE_LOAD_TWICE = f"""
SELECT {_LOADED}, if(docstatus = 1, 'submitted', 'drafts') AS load_id FROM erp_sales_invoice
"""

COUNT_BY_KEY = """
SELECT l_suppkey AS author_id, count(*) AS total_books FROM lineitem GROUP BY l_suppkey
"""

# ---------------------------------------------------------------------------
# Operators
# ---------------------------------------------------------------------------
LATEST_PER_KEY = """
SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem x
WHERE (l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) = (
  SELECT max((l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice))
  FROM lineitem y WHERE y.l_orderkey = x.l_orderkey)
"""

PK_VIOLATIONS = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
"""

FK_ORPHANS = """
SELECT parent, item_code, delivery_note FROM erp_sales_invoice_item
WHERE delivery_note NOT IN (SELECT name FROM erp_delivery_note)
"""

NOT_NULL_VIOLATIONS = """
SELECT column_name, null_rows FROM (
  SELECT count(*) - count(delivery_note) AS delivery_note, count(*) - count(item_code) AS item_code,
         count(*) - count(qty) AS qty FROM erp_sales_invoice_item)
UNPIVOT (null_rows FOR column_name IN (delivery_note, item_code, qty))
"""

DEFAULT_FILL = f"""
SELECT * REPLACE (ifnull(customer_provided_vehicle, '') AS customer_provided_vehicle),
  {LOAD_TIME} AS created_at, {LOAD_TIME} AS updated_at
FROM erp_delivery_note
"""

INCREMENTAL_EXTRACT = f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= {EXTRACT_FROM}
"""

COLUMN_PRUNED_EXTRACT = """
SELECT c_custkey, c_name FROM customer
"""

LANDING_REPORT = f"""
SELECT 'customer.parquet/ds=manual_run' AS landed_at, (SELECT count(*) FROM customer) AS n_rows
UNION ALL SELECT 'lineitem.parquet/ds=2001-07-15', (SELECT count(*) FROM lineitem WHERE l_quantity > 25)
UNION ALL SELECT 'orders.parquet/ds=2001-07-15', (SELECT count(*) FROM orders WHERE o_orderkey < 0)
"""

STAR_SCHEMA_LOAD = """
SELECT o_custkey::INT AS customer_id, l_partkey::INT AS product_sku, (l_orderkey % 3)::INT AS channel_id,
  l_quantity::INT AS quantity, l_discount::DOUBLE AS discount, o_orderdate::TIMESTAMP AS order_date
FROM lineitem, orders WHERE l_orderkey = o_orderkey
"""

CALENDAR = """
SELECT DISTINCT unnest(range(date_trunc('month', posting_date)::DATE, last_day(posting_date) + 1,
                             INTERVAL 1 DAY))::DATE AS posting_date
FROM (SELECT DISTINCT posting_date FROM erp_sales_invoice WHERE posting_date IS NOT NULL)
"""

WEEK_NUMBER = f"""
SELECT posting_date, {_WEEK} AS week_no FROM erp_sales_invoice GROUP BY ALL
"""

FIRST_NON_BLANK = """
SELECT name, list_filter([company_vehicle, customer_provided_vehicle, transporter_vehicle_number],
                         lambda v: v <> '')[1] AS vehicle_number
FROM erp_delivery_note
"""

LOAD_LADDER = f"""
open_lines AS (
  SELECT l.qty - l.delivered_qty AS q, l.weight_per_unit AS w,
    {_rung('l.qty - l.delivered_qty', 'l.weight_per_unit', 'o.currency')} AS rung
  FROM erp_sales_order_item l, erp_sales_order o WHERE o.name = l.parent AND l.qty > l.delivered_qty)
SELECT rung, count(*) AS n_lines, sum(if(rung = 0, q, {_BAGS}[rung]))::DOUBLE AS total_bags,
  sum(w * if(rung = 0, q, {_BAGS}[rung]))::DOUBLE AS total_tonnes
FROM open_lines GROUP BY rung
"""

ANTI_COUNTERPARTY = f"""
SELECT against, sum(credit)::DOUBLE AS amount FROM erp_gl_entry
WHERE is_cancelled = 0 AND credit > 0 AND {_kind('account', 'Bank', 'Cash')}
  AND against NOT IN (SELECT name FROM erp_supplier WHERE supplier_name IS NOT NULL)
GROUP BY against
"""

DETAIL_WITH_TOTAL = """
SELECT if(grouping(status) = 1, 'TOTAL', status) AS status, sum(base_grand_total)::DOUBLE AS total
FROM erp_sales_invoice WHERE docstatus = 1 GROUP BY ROLLUP (status)
"""

# The first pull holds what was stale at the time; the second one the rest.
INCREMENTAL_MERGE = """
SELECT o_orderkey, o_custkey, o_totalprice + if(o_orderdate < TIMESTAMP '1997-06-01', o_orderkey % 3, 0)
  AS o_totalprice, o_orderdate FROM orders
"""

COMPACTED_SNAPSHOT = """
landed AS (
  SELECT o_orderkey, o_totalprice AS price, if(o_orderkey % 7 = 0, NULL, o_orderdate) AS modified, 1 AS pull
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_totalprice + 5, if(o_orderkey % 7 = 0, NULL, o_orderdate), 2
  FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL
  SELECT o_orderkey, o_totalprice + 9, if(o_orderkey % 8 = 0, NULL, o_orderdate), 3
  FROM orders WHERE o_orderkey % 4 = 0)
SELECT o_orderkey AS name, price, CAST(modified AS TIMESTAMP) AS modified FROM landed
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY modified DESC NULLS LAST, pull DESC) = 1
"""

MARKED_PULLS = """
SELECT o_orderkey AS name,
  o_totalprice + if(o_orderkey % 10 = 0 AND o_orderdate < TIMESTAMP '1996-01-01', 7, 0) AS price,
  if(o_orderkey % 10 = 0 AND o_orderdate < TIMESTAMP '1996-01-01', TIMESTAMP '1998-06-01 08:00:00',
     CAST(o_orderdate AS TIMESTAMP)) AS modified
FROM orders
"""

PLANNED_SPLITS = """
SELECT o_orderkey, o_orderpriority, 1 AS n_parts FROM orders
"""

SPLIT_QUERY_EXTRACT = """
SELECT l_suppkey, l_returnflag, count(*) AS n_lines, max(l_shipdate) AS last_ship
FROM lineitem WHERE l_quantity > 10 GROUP BY ALL
"""

DELETED_ROWS = """
SELECT o_orderkey AS name, o_totalprice + 0 AS price, CAST(o_orderdate AS TIMESTAMP) AS modified
FROM orders WHERE o_orderkey % 50 <> 0
"""

DIMENSION_LOAD = """
people AS (
  SELECT c_custkey AS id, n_name AS country, c_custkey % 7 <> 0 AS early, c_custkey % 5 <> 0 AS late,
         if(c_custkey % 3 = 0, NULL, n_name) AS later
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT 'customers' AS dimension, id, if(late, later, country) AS content,
       if(early, '2001-07-01', '2001-07-15') AS created,
       if(NOT early OR late AND later IS DISTINCT FROM country, '2001-07-15', '2001-07-01') AS updated
FROM people WHERE early OR late
UNION ALL
SELECT 'products', p_partkey, p_name, '2001-07-01', if(p_partkey % 4 = 0, '2001-07-15', '2001-07-01')
FROM part
"""

INCREMENT_CHECKS = """
old AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 4 <> 0),
new AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 4 = 0 OR l_linenumber = 3)
SELECT 'repeated' AS check_name, l_orderkey || '-' || l_linenumber AS name, count(*) AS n_rows
FROM (SELECT *, 1 AS is_new FROM new UNION ALL SELECT *, 0 FROM old)
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 AND max(is_new) = 1
UNION ALL
SELECT 'no order', l_orderkey || '-' || l_linenumber, count(*) FROM new
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 6 <> 0)
GROUP BY l_orderkey, l_linenumber
"""

RUNNING_TOTALS = """
daily AS (
  SELECT posting_date, customer, sum(base_grand_total) AS amount
  FROM erp_sales_invoice WHERE docstatus = 1 GROUP BY ALL)
SELECT posting_date, customer, amount::DOUBLE AS amount,
  (sum(amount) OVER (ORDER BY posting_date, customer))::DOUBLE AS total,
  (sum(amount) OVER (PARTITION BY customer ORDER BY posting_date))::DOUBLE AS customer_total
FROM daily
"""

HOT_KEY_LOOKUP = """
SELECT s_name, count(*) AS n_lines, sum(l_quantity)::DOUBLE AS quantity
FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 1 WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS k,
             l_quantity FROM lineitem)
LEFT JOIN supplier ON s_suppkey = k GROUP BY s_name
"""

_BODIES = {
    "supplier_total_owed": SUPPLIER_TOTAL_OWED,
    "supplier_balances": SUPPLIER_BALANCES,
    "ap_ageing": AP_AGEING,
    "party_balance": PARTY_BALANCE,
    "receipts_by_account": RECEIPTS_BY_ACCOUNT,
    "receipts_detail": RECEIPTS_DETAIL,
    "supplier_payments": SUPPLIER_PAYMENTS,
    "cash_flow": CASH_FLOW,
    "cash_flow_totals": CASH_FLOW_TOTALS,
    "net_profit": NET_PROFIT,
    "income_expense_by_parent": INCOME_EXPENSE_BY_PARENT,
    "daily_sales": DAILY_SALES,
    "customer_contribution": CUSTOMER_CONTRIBUTION,
    "weekly_sales": WEEKLY_SALES,
    "item_sales_report": ITEM_SALES_REPORT,
    "delivery_targets": DELIVERY_TARGETS,
    "target_tracker": TARGET_TRACKER,
    "calendar_target_tracker": CALENDAR_TARGET_TRACKER,
    "delivery_targets_by_order": DELIVERY_TARGETS_BY_ORDER,
    "raw_material_purchases": RAW_MATERIAL_PURCHASES,
    "purchased_items": PURCHASED_ITEMS,
    "total_revenue": TOTAL_REVENUE,
    "sales_invoice_load": SALES_INVOICE_LOAD,
    "invoice_load_twice": INVOICE_LOAD_TWICE,
    "count_by_key": COUNT_BY_KEY,
    "latest_per_key": LATEST_PER_KEY,
    "pk_violations": PK_VIOLATIONS,
    "fk_orphans": FK_ORPHANS,
    "not_null_violations": NOT_NULL_VIOLATIONS,
    "default_fill": DEFAULT_FILL,
    "incremental_extract": INCREMENTAL_EXTRACT,
    "column_pruned_extract": COLUMN_PRUNED_EXTRACT,
    "landing_report": LANDING_REPORT,
    "star_schema_load": STAR_SCHEMA_LOAD,
    "calendar": CALENDAR,
    "week_number": WEEK_NUMBER,
    "first_non_blank": FIRST_NON_BLANK,
    "load_ladder": LOAD_LADDER,
    "anti_counterparty": ANTI_COUNTERPARTY,
    "detail_with_total": DETAIL_WITH_TOTAL,
    "incremental_merge": INCREMENTAL_MERGE,
    "compacted_snapshot": COMPACTED_SNAPSHOT,
    "marked_pulls": MARKED_PULLS,
    "planned_splits": PLANNED_SPLITS,
    "split_query_extract": SPLIT_QUERY_EXTRACT,
    "deleted_rows": DELETED_ROWS,
    "dimension_load": DIMENSION_LOAD,
    "tracker_by_increments": TARGET_TRACKER,
    "increment_checks": INCREMENT_CHECKS,
    "running_totals": RUNNING_TOTALS,
    "hot_key_lookup": HOT_KEY_LOOKUP,
}


def oracle_queries() -> dict[str, str]:
    return {name: with_views(body) for name, body in _BODIES.items()}
