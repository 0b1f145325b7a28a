"""Finance reports over the general ledger, journals, invoices and payments.

Plan shape shared by all of them: filter the fact table first (the filters
reach the Parquet scan), reduce it to one row per key with a partial+final
hash aggregate, and only then attach dimension attributes. Dimensions are
looked up by their unique ``name``; joins whose only purpose is existence
are semi joins, so nothing fans out by accident.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import (DateLike, convert_currency, date_lit, is_salary_account,
                                 in_bucket, money)
from ..operators.aggregates import grouped_with_text_max
from ..operators.relational import exists_in, lookup, union_all


def _between(c: str, start: DateLike, end: DateLike) -> Column:
    return F.col(c).between(date_lit(start), date_lit(end))


# ---------------------------------------------------------------------------
# RPT-1 / RPT-1b: amounts owed to suppliers
# ---------------------------------------------------------------------------

def _supplier_balance_sums(gl_entry: DataFrame, account: DataFrame) -> DataFrame:
    """Credit minus debit per party on payable accounts, not cancelled."""
    payable = account.where(F.col("account_type") == C.ACCOUNT_PAYABLE)
    gl = gl_entry.where(F.col("is_cancelled") == C.NOT_CANCELLED)
    gl = exists_in(gl, payable, "account", "name")
    return (gl.groupBy("party")
              .agg((F.sum("credit") - F.sum("debit")).alias("supplier_balances")))


def supplier_balances(gl_entry: DataFrame, account: DataFrame,
                      supplier: DataFrame) -> DataFrame:
    """RPT-1b: balance per supplier party (unfiltered).

    Grouping by (party, supplier name) equals grouping by party because the
    supplier name comes from a unique-key lookup; the lookup runs on the
    aggregate (one row per party), not on the ledger.
    """
    sums = _supplier_balance_sums(gl_entry, account)
    out = lookup(sums, supplier, "party", "name", ["supplier_name"])
    return out.select("party", "supplier_name", money("supplier_balances").alias("supplier_balances"))


def supplier_total_owed(gl_entry: DataFrame, account: DataFrame,
                        supplier: DataFrame) -> DataFrame:
    """RPT-1: total of the positive supplier balances (one row)."""
    sums = _supplier_balance_sums(gl_entry, account)
    return (sums.where(F.col("supplier_balances") > 0)
                .agg(money(F.sum("supplier_balances")).alias("total_owed")))


# ---------------------------------------------------------------------------
# RPT-3: party balance
# ---------------------------------------------------------------------------

def party_balance(gl_entry: DataFrame, party: str, by_currency: bool = False) -> DataFrame:
    """RPT-3: debit minus credit in transaction currency for one party.

    The source groups by party only and shows a currency (SEM-1); the
    currency shown is the largest one. ``by_currency=True`` splits instead.
    """
    gl = gl_entry.where((F.col("party") == party) &
                        (F.col("is_cancelled") == C.NOT_CANCELLED))
    bal = (F.sum("debit_in_transaction_currency")
           - F.sum("credit_in_transaction_currency"))
    if by_currency:
        return gl.groupBy("party", "transaction_currency").agg(money(bal).alias("balance"))
    sums = {"debits": ("sum", F.col("debit_in_transaction_currency")),
            "credits": ("sum", F.col("credit_in_transaction_currency"))}
    out = grouped_with_text_max(gl, ["party"], ["transaction_currency"], sums)
    return out.select("party", "transaction_currency",
                      money(F.col("debits") - F.col("credits")).alias("balance"))


# ---------------------------------------------------------------------------
# RPT-4 / RPT-5: receipts and payments through cash accounts
# ---------------------------------------------------------------------------

def _cash_ledger(gl_entry: DataFrame, account: DataFrame, start: DateLike, end: DateLike,
                 excluded_accounts: Sequence[str]) -> DataFrame:
    """Ledger rows on bank/cash accounts in the period, not cancelled."""
    gl = gl_entry.where((F.col("is_cancelled") == C.NOT_CANCELLED)
                        & _between("posting_date", start, end)
                        & ~F.col("account").isin(*excluded_accounts))
    return gl


def _cash_accounts(account: DataFrame) -> DataFrame:
    return account.where(F.col("account_type").isin(*C.CASH_ACCOUNT_TYPES))


_RECEIPT_COLUMNS = ["posting_date", "account", "debit", "credit", "against", "party_type",
                    "customer_name", "voucher_type", "voucher_no", "voucher_subtype",
                    "against_voucher_type", "against_voucher"]


def _receipt_rows(gl_entry, account, start, end, excluded_accounts):
    gl = _cash_ledger(gl_entry, account, start, end, excluded_accounts)
    gl = gl.where(F.col("voucher_subtype").isin(*C.SUBTYPES_RECEIPT) & (F.col("debit") > 0)
                  & F.col("against").isNotNull())
    return exists_in(gl, _cash_accounts(account), "account", "name")


def receipts_detail(gl_entry: DataFrame, account: DataFrame, customer: DataFrame,
                    start: DateLike, end: DateLike,
                    excluded_accounts: Sequence[str] = ()) -> DataFrame:
    """RPT-4b: money received from customers into bank/cash accounts."""
    gl = _receipt_rows(gl_entry, account, start, end, excluded_accounts)
    rows = lookup(gl, customer, "against", "name", ["customer_name"], how="inner")
    return rows.select(*[money(c).alias(c) if c in ("debit", "credit") else F.col(c)
                         for c in _RECEIPT_COLUMNS])


def receipts_by_account(gl_entry: DataFrame, account: DataFrame, customer: DataFrame,
                        start: DateLike, end: DateLike,
                        excluded_accounts: Sequence[str] = ()) -> DataFrame:
    """RPT-4: money received per bank/cash account.

    Receipts are summed per account and counterparty before the counterparty
    is looked up, so a hot one is one row there."""
    gl = _receipt_rows(gl_entry, account, start, end, excluded_accounts)
    sums = gl.groupBy("account", "against").agg(F.sum("debit").alias("debit"))
    rows = exists_in(sums, customer, "against", "name")
    return (rows.groupBy(F.col("account").alias("account_name"))
                .agg(money(F.sum("debit")).alias("money_in")))


_PAYMENT_COLUMNS = ["posting_date", "account", "debit", "credit", "against", "party_type",
                    "supplier_name", "parent_account", "voucher_type", "voucher_no",
                    "voucher_subtype", "against_voucher_type", "against_voucher"]


def _supplier_payment_rows(gl_entry, account, start, end, excluded_accounts):
    gl = _cash_ledger(gl_entry, account, start, end, excluded_accounts)
    return gl.where(F.col("voucher_subtype").isin(*C.SUBTYPES_PAYMENT) & (F.col("credit") > 0))


def supplier_payments(gl_entry: DataFrame, account: DataFrame, supplier: DataFrame,
                      start: DateLike, end: DateLike,
                      excluded_accounts: Sequence[str] = ()) -> DataFrame:
    """RPT-5: payments to suppliers out of bank/cash accounts (detail rows).

    ``parent_account`` is the paying account's parent (BUG-5).
    """
    gl = _supplier_payment_rows(gl_entry, account, start, end, excluded_accounts)
    gl = lookup(gl, _cash_accounts(account), "account", "name", ["parent_account"], how="inner")
    gl = lookup(gl, supplier, "against", "name", ["supplier_name"], how="inner")
    return gl.select(*[money(c).alias(c) if c in ("debit", "credit") else F.col(c)
                       for c in _PAYMENT_COLUMNS])


# ---------------------------------------------------------------------------
# RPT-6 / RPT-6b: cash flow
# ---------------------------------------------------------------------------

def payroll_rows(supplier: DataFrame, party_account: DataFrame,
                           account: DataFrame) -> DataFrame:
    """Suppliers whose party account sits under a payroll parent account."""
    acc = account.where(F.col("parent_account").like(C.PAYROLL_PARENT_PATTERN))
    pa = lookup(party_account, acc, "account", "name", ["parent_account"], how="inner")
    out = lookup(pa, supplier, "parent", "name", ["supplier_name"], how="inner")
    return out.select(F.col("parent").alias("supplier_id"), "supplier_name",
                      F.col("account").alias("party_account"), "parent_account")


def counterparties(customer: DataFrame, supplier: DataFrame, payroll: DataFrame,
                   payroll_parent: str) -> DataFrame:
    """One row per counterparty name with what the cash-flow branches test.

    is_customer / is_supplier: the name is a customer / supplier;
    named_supplier: a supplier with a name (the other-drawings test);
    n_salary / n_other: payroll party-account rows of the supplier whose
    parent is / is not the payroll parent. The source joins these rows to
    every payment (a payment repeats once per row, or appears once as a
    supplier payment without rows); the counts reproduce that exactly.
    """
    zero, one = F.lit(0), F.lit(1)
    salary = F.when(is_salary_account("parent_account", payroll_parent), 1).otherwise(0)
    rows = union_all([
        customer.select(F.col("name"), one.alias("is_customer"), zero.alias("is_supplier"),
                        zero.alias("named_supplier"), zero.alias("n_salary"), zero.alias("n_other")),
        supplier.select(F.col("name"), zero, one,
                        F.when(F.col("supplier_name").isNotNull(), 1).otherwise(0), zero, zero),
        payroll.select(F.col("supplier_id"), zero, zero, zero, salary, 1 - salary),
    ])
    return rows.groupBy("name").agg(
        F.max("is_customer").alias("is_customer"), F.max("is_supplier").alias("is_supplier"),
        F.max("named_supplier").alias("named_supplier"),
        F.sum("n_salary").alias("n_salary"), F.sum("n_other").alias("n_other"))


def _cash_flow_rows(t, start: DateLike, end: DateLike, excluded_accounts: Sequence[str],
                    excluded_counterparties: Sequence[str], payroll_parent: str,
                    dedupe_payroll: bool = False) -> DataFrame:
    """(Cash_Flow_Category, account_name, amount) with exact decimal amounts.

    One pass over the period's cash-account ledger rows. Every branch tests
    the counterparty, so rows without one are dropped and the others summed
    per account, counterparty and subtype; only these sums meet the
    counterparty table and emit their contributions (collections by account,
    supplier outflow by salary/supplier category, other drawings by
    counterparty) into the last aggregate.
    """
    gl = _cash_ledger(t.gl_entry, t.account, start, end, excluded_accounts)
    gl = gl.where(F.col("against").isNotNull())
    gl = exists_in(gl, _cash_accounts(t.account), "account", "name")
    gl = gl.groupBy("account", "against", "voucher_subtype").agg(
        F.sum(F.when(F.col("debit") > 0, F.col("debit"))).alias("debit"),
        F.sum(F.when(F.col("credit") > 0, F.col("credit"))).alias("credit"))
    parties = counterparties(t.customer, t.supplier,
                             payroll_rows(t.supplier, t.party_account, t.account),
                             payroll_parent)
    rows = lookup(gl, parties, "against", "name",
                  ["is_customer", "is_supplier", "named_supplier", "n_salary", "n_other"])

    def flag(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    subtype, against = F.col("voucher_subtype"), F.col("against")
    debit, credit = F.col("debit"), F.col("credit")
    receipt = subtype.isin(*C.SUBTYPES_RECEIPT) & (debit > 0) & (flag("is_customer") == 1)
    payment = subtype.isin(*C.SUBTYPES_PAYMENT) & (credit > 0) & (flag("is_supplier") == 1)
    drawing = (~subtype.isin(*C.SUBTYPES_NOT_DRAWING) & (credit > 0)
               & (flag("named_supplier") == 0) & ~against.isin(*excluded_counterparties))
    n_salary = flag("n_salary")
    n_supplier = flag("n_other") + F.when(flag("n_salary") + flag("n_other") == 0, 1).otherwise(0)
    if dedupe_payroll:
        # each payment once: a salary payment when any payroll row matches
        n_salary = F.when(n_salary > 0, 1).otherwise(0)
        n_supplier = 1 - n_salary

    def entry(keep: Column, category: str, label: Column, amount: Column) -> Column:
        return F.struct(keep.alias("keep"), F.lit(category).alias("Cash_Flow_Category"),
                        label.alias("account_name"), amount.cast(C.WIDE_MONEY).alias("amount"))

    entries = F.array(
        entry(receipt, C.LABEL_COLLECTIONS, F.col("account"), debit),
        entry(payment & (n_salary > 0), C.LABEL_OUTFLOW, F.lit(C.LABEL_SALARY), credit * n_salary),
        entry(payment & (n_supplier > 0), C.LABEL_OUTFLOW, F.lit(C.LABEL_SUPPLIER_PAYMENT),
              credit * n_supplier),
        entry(drawing, C.LABEL_DRAWINGS, against, credit))
    contributions = rows.select(F.inline(F.filter(entries, lambda e: e["keep"])))
    return (contributions.groupBy("Cash_Flow_Category", "account_name")
                         .agg(F.sum("amount").cast(C.WIDE_MONEY).alias("amount")))


def cash_flow(t, start: DateLike, end: DateLike, excluded_accounts: Sequence[str] = (),
              excluded_counterparties: Sequence[str] = (),
              payroll_parent: str = "", dedupe_payroll: bool = False) -> DataFrame:
    """RPT-6: collections, supplier outflow and other drawings in one table.

    A supplier with several payroll party accounts repeats its payments, as
    in the source; ``dedupe_payroll=True`` counts each payment once.
    """
    rows = _cash_flow_rows(t, start, end, excluded_accounts, excluded_counterparties,
                           payroll_parent, dedupe_payroll)
    return rows.select("Cash_Flow_Category", "account_name", money("amount").alias("amount"))


def cash_flow_totals(t, start: DateLike, end: DateLike, excluded_accounts: Sequence[str] = (),
                     excluded_counterparties: Sequence[str] = (),
                     payroll_parent: str = "", dedupe_payroll: bool = False) -> DataFrame:
    """RPT-6b: the three category totals in one row."""
    rows = _cash_flow_rows(t, start, end, excluded_accounts, excluded_counterparties,
                           payroll_parent, dedupe_payroll)
    cat = F.col("Cash_Flow_Category")

    def total(label: str) -> Column:
        return money(F.sum(F.when(cat == label, F.col("amount")).otherwise(F.lit(0))))

    return (rows.groupBy(F.lit(C.LABEL_BALANCE).alias("Totals"))
                .agg(total(C.LABEL_COLLECTIONS).alias("collections"),
                     total(C.LABEL_OUTFLOW).alias("Supplier_payments"),
                     total(C.LABEL_DRAWINGS).alias("other_drawings")))


# ---------------------------------------------------------------------------
# RPT-7 / RPT-7b: income, expenses, net profit
# ---------------------------------------------------------------------------

def _income_expense(gl_entry: DataFrame, account: DataFrame, start: DateLike,
                    end: DateLike, company: str) -> DataFrame:
    gl = gl_entry.where((F.col("is_cancelled") == C.NOT_CANCELLED)
                        & _between("posting_date", start, end))
    # Per-account sums first: the ledger collapses to one row per account
    # before it meets the chart of accounts.
    per_account = gl.groupBy("account").agg(F.sum(F.col("debit") - F.col("credit")).alias("dmc"))
    acc = account.where(F.col("root_type").isin(C.ROOT_INCOME, C.ROOT_EXPENSE))
    per_account = lookup(per_account, acc, "account", "name",
                         ["parent_account", "root_type"], how="inner")
    root = F.col("root_type")
    return (per_account.groupBy("parent_account")
                       .agg(F.sum(F.when(root == C.ROOT_EXPENSE, F.col("dmc"))).alias("total_expenses"),
                            F.sum(F.when(root == C.ROOT_INCOME, -F.col("dmc"))).alias("total_income"))
                       .select(F.lit(company).alias("company"), "parent_account",
                               "total_expenses", "total_income"))


def income_expense_by_parent(gl_entry: DataFrame, account: DataFrame, start: DateLike,
                             end: DateLike, company: str) -> DataFrame:
    """RPT-7b: expenses and income per parent account (NULL when absent)."""
    rows = _income_expense(gl_entry, account, start, end, company)
    return rows.select("company", "parent_account",
                       money("total_expenses").alias("total_expenses"),
                       money("total_income").alias("total_income"))


def net_profit(gl_entry: DataFrame, account: DataFrame, start: DateLike, end: DateLike,
               company: str) -> DataFrame:
    """RPT-7: income minus expenses; NULL if either side is wholly absent."""
    rows = _income_expense(gl_entry, account, start, end, company)
    return rows.agg(F.max("company").alias("company"),
                    F.lit(C.LABEL_NET_PROFIT).alias("Account"),
                    money(F.sum("total_income") - F.sum("total_expenses")).alias("Net_Profit"),
                    F.lit("").alias("Account_type"))


# ---------------------------------------------------------------------------
# RPT-2: accounts-payable ageing (flagship)
# ---------------------------------------------------------------------------

BUCKET_NAMES = [name for name, _, _ in C.AGEING_BUCKETS]

# Columns of the per-source rows that feed the single ageing aggregate.
_AGEING_ROW = ["supplier_id", "invoice_name", *BUCKET_NAMES, "outstanding", "paid",
               "owed", "journal_credit"]


def open_purchase_invoices(purchase_invoice: DataFrame, as_of: DateLike) -> DataFrame:
    """Stage a: submitted, unpaid, non-return invoices due on or before as_of.

    ``DATEDIFF(as_of, due_date) >= 0`` is written as ``due_date <= as_of`` so
    the predicate reaches the scan.
    """
    d = date_lit(as_of)
    pi = purchase_invoice.where((F.col("docstatus") == C.SUBMITTED)
                                & ~F.col("status").isin(*C.INVOICE_STATUS_CLOSED)
                                & (F.col("due_date") <= d))
    amount = convert_currency("outstanding_amount", "party_account_currency", "conversion_rate")
    return pi.select(F.col("supplier").alias("supplier_id"), "supplier_name",
                     amount.cast(C.WIDE_MONEY).alias("amount"),
                     F.datediff(d, F.col("due_date")).alias("days_after_due_date"))


def supplier_journal_lines(journal_entry_account: DataFrame, journal_entry: DataFrame,
                           account: DataFrame) -> DataFrame:
    """Journal lines on payable accounts for suppliers (submitted line and
    header, header not system generated): the base of stages c, g and j."""
    lines = journal_entry_account.where((F.col("docstatus") == C.SUBMITTED)
                                        & (F.col("party_type") == C.PARTY_SUPPLIER))
    headers = journal_entry.where((F.col("docstatus") == C.SUBMITTED)
                                  & (F.col("is_system_generated") == C.NOT_SYSTEM_GENERATED))
    # the selective dimension first: Spark does not reorder semi joins
    payable = account.where(F.col("account_type") == C.ACCOUNT_PAYABLE)
    lines = exists_in(lines, payable, "account", "name")
    return exists_in(lines, headers, "parent", "name")


def _rows(supplier: Column, invoice_name: Column | None = None,
          buckets: list[Column] | None = None, outstanding: Column | None = None,
          paid: Column | None = None, owed: Column | None = None,
          journal_credit: Column | None = None) -> list[Column]:
    none = F.lit(None).cast(C.WIDE_MONEY)
    zero = F.lit(0).cast(C.WIDE_MONEY)
    return [supplier.alias("supplier_id"),
            (invoice_name if invoice_name is not None else F.lit(None).cast("string"))
            .alias("invoice_name"),
            *[(b.cast(C.WIDE_MONEY) if buckets else zero).alias(n)
              for b, n in zip(buckets or BUCKET_NAMES, BUCKET_NAMES)],
            (outstanding.cast(C.WIDE_MONEY) if outstanding is not None else none).alias("outstanding"),
            (paid.cast(C.WIDE_MONEY) if paid is not None else none).alias("paid"),
            (owed if owed is not None else F.lit(0)).alias("owed"),
            (journal_credit if journal_credit is not None else F.lit(0)).alias("journal_credit")]


def ageing_rows(t, as_of: DateLike) -> DataFrame:
    """Stages a to l as one stream of per-supplier contributions.

    Every source is read once and contributes rows of the same shape:
    open invoices (bucket amounts, outstanding), journal lines (credits are
    outstanding, debits are payments), unallocated payment entries and
    payments allocated to journals (payments). Payment rows without a party
    are dropped: in the source they are grouped under a NULL key that never
    joins the outstanding side.
    """
    inv = open_purchase_invoices(t.purchase_invoice, as_of)
    days, amt = F.col("days_after_due_date"), F.col("amount")
    invoices = inv.select(*_rows(
        F.col("supplier_id"), F.col("supplier_name"),
        buckets=[F.when(in_bucket(days, lo, hi), amt).otherwise(F.lit(0))
                 for _, lo, hi in C.AGEING_BUCKETS],
        outstanding=amt, owed=F.lit(1)))

    lines = supplier_journal_lines(t.journal_entry_account, t.journal_entry, t.account)
    ref_type, ref_name = F.col("reference_type"), F.col("reference_name")
    credit, debit, party = F.col("credit"), F.col("debit"), F.col("party")
    is_credit = (credit > 0) & ref_type.isNull() & ref_name.isNull()                  # c
    is_payment = (debit > 0) & (ref_type.isNull()                                     # g
                                | (ref_type != C.DOCTYPE_PURCHASE_INVOICE))           # j
    journals = (lines.where(is_credit | (is_payment & party.isNotNull()))
                .select(*_rows(party,
                               outstanding=F.when(is_credit, credit),
                               paid=F.when(is_payment & party.isNotNull(), debit),
                               owed=F.when(is_credit, 1).otherwise(0),
                               journal_credit=F.when(is_credit, 1).otherwise(0))))

    pe = t.payment_entry.where((F.col("docstatus") == C.SUBMITTED)
                               & (F.col("payment_type") == C.PAYMENT_PAY)
                               & (F.col("party_type") == C.PARTY_SUPPLIER)
                               & F.col("party").isNotNull())
    unallocated = F.col("base_paid_amount") - F.col("base_total_allocated_amount")
    payments = pe.where(unallocated > 0).select(*_rows(F.col("party"), paid=unallocated))  # f

    # Allocations to journal entries, summed per payment entry before they
    # meet the payment header (i).
    alloc = (t.payment_entry_reference
             .where(F.col("reference_doctype") == C.DOCTYPE_JOURNAL_ENTRY)
             .groupBy("parent").agg(F.sum("allocated_amount").alias("allocated")))
    allocated = (lookup(alloc, pe, "parent", "name", ["party"], how="inner")
                 .select(*_rows(F.col("party"), paid=F.col("allocated"))))

    return union_all([invoices.select(*_AGEING_ROW), journals.select(*_AGEING_ROW),
                      payments.select(*_AGEING_ROW), allocated.select(*_AGEING_ROW)])


def ap_ageing(t, as_of: DateLike) -> DataFrame:
    """RPT-2: accounts-payable ageing per supplier, largest balance first.

    Output: supplier_id, supplier_name, 0-30, 31-60, 61-90, 91-120,
    121-Above, Unallocated_Amount, Total_Outstanding, Balance.

    One aggregate by supplier over ``ageing_rows``: partial sums are built
    where the rows are read, so the only full shuffle carries one row per
    supplier and task. A supplier is reported when it has an open invoice or
    a journal credit (``owed``); suppliers with payments only do not appear.
    The supplier master name is looked up for suppliers with journal credits
    and compared with the invoice name, as the source takes either.
    """
    sums = {n: ("sum", F.col(f"`{n}`")) for n in BUCKET_NAMES}
    sums.update({"Total_Outstanding": ("sum", F.col("outstanding")),
                 "total_debits": ("sum", F.col("paid")),
                 "owed": ("max", F.col("owed")),
                 "journal_credit": ("max", F.col("journal_credit"))})
    per_supplier = (grouped_with_text_max(ageing_rows(t, as_of), ["supplier_id"],
                                          ["invoice_name"], sums)
                    .where(F.col("owed") == 1))
    named = lookup(per_supplier, t.supplier, "supplier_id", "name", ["supplier_name"])
    name = F.greatest(F.col("invoice_name"),
                      F.when(F.col("journal_credit") == 1, F.col("supplier_name")))
    paid = F.coalesce(F.col("total_debits"), F.lit(0))
    balance = F.coalesce(F.col("Total_Outstanding"), F.lit(0)) - paid
    out = named.select(
        "supplier_id", name.alias("supplier_name"),
        *[money(F.coalesce(F.col(f"`{n}`"), F.lit(0))).alias(n) for n in BUCKET_NAMES],
        money(paid).alias("Unallocated_Amount"),
        money("Total_Outstanding").alias("Total_Outstanding"),
        money(balance).alias("Balance"))
    return out.where(F.col("Balance") > 0).orderBy(F.col("Balance").desc())
