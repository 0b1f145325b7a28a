"""ERP-shaped tables derived from the TPC-H-style test tables.

The test folder holds ``orders``, ``lineitem``, ``customer``, ``supplier``,
``part`` and ``nation``. Every ERP table the reports read is derived from
them with column expressions and joins, so the work of each report grows
with the test tables. The derivation rules are the ones in FIXTURES.md §3.

``ErpTables`` exposes one lazily built DataFrame per ERP table; nothing is
read until a report runs an action. ``LandedTables`` reads the same tables
from a landing folder written by ``sources.extract.land_tables``.
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ERP_TABLES = (
    "supplier", "customer", "company", "item", "account", "party_account",
    "sales_invoice", "sales_invoice_item", "delivery_note", "sales_team",
    "sales_order", "sales_order_item", "purchase_invoice",
    "purchase_invoice_item", "journal_entry", "journal_entry_account",
    "payment_entry", "payment_entry_reference", "gl_entry",
)


def _s(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def _name(prefix: str, col: str | Column) -> Column:
    return F.concat(F.lit(prefix), _s(col))


class ErpTables:
    """ERP tables over one test-data folder (``.../sf0.01``).

    ``dealt`` tables are ready to be landed: what has a date comes in ranges of
    it, dealt and sorted before the table's columns are made, so the few columns
    they are made of are moved, and one row where several are made of it. Lines
    come as even as the splits of their scan, or as the parts of their join,
    which adaptive execution splits when skewed.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, dealt: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.dealt = dealt

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _ranged(self, rows: DataFrame, day: str, key: str) -> DataFrame:
        """``rows`` in ranges of a day, with the key so that a busy day can be
        split; as they are unless the tables are dealt."""
        by = [F.col(day).cast("date"), F.col(key)]
        return rows.repartitionByRange(*by).sortWithinPartitions(*by) if self.dealt else rows

    # -- shared order-level base ("O" in FIXTURES.md) ----------------------
    @cached_property
    def _order_rows(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("ck"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amt"),
            F.col("o_orderdate").cast("date").alias("d"),
            F.col("o_orderstatus").alias("st"),
            F.col("o_orderpriority").alias("pr"))

    def _with_names(self, orders: DataFrame) -> DataFrame:
        # The supplier count is a scalar subquery: computed once, one value.
        nsup = self.raw("supplier").select(F.count(F.lit(1))).scalar()
        k, ck = F.col("k"), F.col("ck")
        return orders.select(
            "*",
            _name("CUST-", ck).alias("cust"),
            _name("SUP-", (k * 7 + ck) % nsup).alias("sup"),
            F.when(k % 25 == 0, 1).otherwise(0).alias("canc"),
            F.when(k % 3 == 0, "USD").otherwise("KES").alias("cur"))

    @cached_property
    def _orders(self) -> DataFrame:
        return self._with_names(self._order_rows)

    @cached_property
    def _orders_with_customer(self) -> DataFrame:
        cust = self.raw("customer").select("c_custkey", "c_name")
        return self._with_names(self._ranged(
            self._order_rows.join(cust, F.col("ck") == F.col("c_custkey")).drop("c_custkey"), "d", "k"))

    def _docstatus(self) -> Column:
        return F.when(F.col("st") == "P", 0).otherwise(1)

    # -- masters -----------------------------------------------------------
    @cached_property
    def supplier(self) -> DataFrame:
        return self.raw("supplier").select(
            _name("SUP-", "s_suppkey").alias("name"),
            F.col("s_name").alias("supplier_name"))

    @cached_property
    def customer(self) -> DataFrame:
        return self.raw("customer").select(
            _name("CUST-", "c_custkey").alias("name"),
            F.col("c_name").alias("customer_name"))

    @cached_property
    def company(self) -> DataFrame:
        # The single company every test invoice is booked to.
        return self.raw("region").select(F.lit("MAIN").alias("name")).distinct()

    @cached_property
    def item(self) -> DataFrame:
        return self.raw("part").select(
            _name("ITM-", "p_partkey").alias("name"),
            F.col("p_name").alias("item_name"),
            F.when(F.col("p_type") == "ECONOMY", "RAW MATERIALS")
             .otherwise(F.col("p_type")).alias("item_group"))

    @cached_property
    def account(self) -> DataFrame:
        nk = F.col("n_nationkey")
        m5 = nk % 5
        return self.raw("nation").select(
            _name("ACC-", nk).alias("name"),
            F.when(m5 == 0, "Payable").when(m5 == 1, "Receivable")
             .when(m5 == 2, "Bank").when(m5 == 3, "Cash")
             .otherwise("Other").alias("account_type"),
            F.when(m5 == 0, "Liability").when(m5 < 4, "Asset")
             .when(nk % 2 == 0, "Income").otherwise("Expense").alias("root_type"),
            F.when(nk % 10 == 0, "2500 - Payroll Liabilities")
             .otherwise(_name("GROUP-", nk % 3)).alias("parent_account"),
            F.lit(0).alias("is_group"))

    @cached_property
    def party_account(self) -> DataFrame:
        sk = F.col("s_suppkey")
        return self.raw("supplier").select(
            _name("SUP-", sk).alias("parent"),
            _name("ACC-", (sk % 5) * 5).alias("account"))

    # -- sales -------------------------------------------------------------
    @cached_property
    def sales_invoice(self) -> DataFrame:
        k, amt = F.col("k"), F.col("amt")
        return self._orders_with_customer.select(
            _name("SI-", k).alias("name"),
            F.col("cust").alias("customer"),
            F.col("c_name").alias("customer_name"),
            F.col("d").alias("posting_date"),
            F.date_add("d", 30).alias("due_date"),
            amt.alias("base_grand_total"),
            self._docstatus().alias("docstatus"),
            F.when(F.col("pr") == "1-URGENT", "Return")
             .when(F.col("pr") == "5-LOW", "Paid").otherwise("Unpaid").alias("status"),
            F.when(k % 50 == 1, "Yes").otherwise("No").alias("is_opening"),
            F.lit("MAIN").alias("company"),
            _name("EXP-", k % 9).alias("export_series"),
            _name("ETR-", k).alias("etr_invoice_number"),
            F.when(k % 3 == 0, "Export").otherwise("Local").alias("tax_category"),
            _name("TAX-", "ck").alias("tax_id"),
            F.when(k % 4 == 0, F.lit(0)).otherwise(amt * F.lit(0.16).cast("decimal(2,2)"))
             .cast("decimal(18,2)").alias("base_total_taxes_and_charges"),
            F.when(k % 50 == 2, F.lit(0)).otherwise(k % 40 + 1)
             .cast("decimal(18,2)").alias("total_qty"))

    def _lines_with_part(self) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_name")
        return self.raw("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))

    @cached_property
    def sales_invoice_item(self) -> DataFrame:
        q, p = F.col("l_quantity"), F.col("l_extendedprice")
        return self._lines_with_part().select(
            _name("SI-", "l_orderkey").alias("parent"),
            _name("ITM-", "l_partkey").alias("item_code"),
            F.col("p_name").alias("item_name"),
            q.cast("decimal(18,2)").alias("qty"),
            p.cast("decimal(18,2)").alias("base_rate"),
            (p * q).cast("decimal(18,2)").alias("base_amount"),
            (q * 0.025).cast("decimal(18,3)").alias("tonnes_input"),
            F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("string"))
             .otherwise(_name("DN-", "l_orderkey")).alias("delivery_note"))

    @cached_property
    def delivery_note(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").where(k % 2 == 0).select(
            _name("DN-", k).alias("name"),
            F.when(k % 6 == 0, _name("CV-", k % 7)).otherwise("").alias("company_vehicle"),
            F.when(k % 4 == 0, _name("PV-", k % 5))
             .otherwise(F.lit(None).cast("string")).alias("customer_provided_vehicle"),
            F.when(k % 10 == 2, "TV-1").otherwise("").alias("transporter_vehicle_number"))

    @cached_property
    def sales_team(self) -> DataFrame:
        cust, orders = self.raw("customer"), self.raw("orders")
        ck, ok = F.col("c_custkey"), F.col("o_orderkey")
        cols = ["parent", "sales_person"]
        return (
            cust.where(ck % 3 != 0).select(
                _name("CUST-", ck).alias("parent"),
                _name("SP-", "c_nationkey").alias("sales_person"))
            .unionByName(cust.where(ck % 10 == 1).select(
                _name("CUST-", ck).alias("parent"), F.lit("SP-X").alias("sales_person")))
            .unionByName(orders.where(ok % 4 != 0).select(
                _name("SO-", ok).alias("parent"),
                _name("SP-", F.col("o_custkey") % 25).alias("sales_person")))
            .unionByName(orders.where(ok % 9 == 1).select(
                _name("SO-", ok).alias("parent"), F.lit("SP-X").alias("sales_person")))
            .select(*cols))

    @cached_property
    def sales_order(self) -> DataFrame:
        k = F.col("k")
        return self._orders_with_customer.select(
            _name("SO-", k).alias("name"),
            F.col("d").alias("creation"),
            F.col("d").alias("transaction_date"),
            F.date_add("d", 14).alias("delivery_date"),
            F.col("c_name").alias("customer_name"),
            (k % 100).cast("int").alias("per_delivered"),
            (k % 90).cast("int").alias("per_billed"),
            F.when(F.col("pr") == "5-LOW", "Completed")
             .when(F.col("pr") == "4-NOT SPECIFIED", "On Hold")
             .otherwise("To Deliver and Bill").alias("status"),
            F.col("cur").alias("currency"),
            F.when(F.col("cur") == "USD", F.lit(129.5)).otherwise(F.lit(1))
             .cast("decimal(9,4)").alias("conversion_rate"),
            self._docstatus().alias("docstatus"))

    @cached_property
    def sales_order_item(self) -> DataFrame:
        pk, ln, q = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_quantity")
        return self._lines_with_part().select(
            _name("SO-", "l_orderkey").alias("parent"),
            F.when(pk % 20 == 0, "SRV-001").otherwise(_name("ITM-", pk)).alias("item_code"),
            F.col("p_name").alias("item_name"),
            F.when(pk % 2 == 0, F.lit(0.025)).otherwise(F.lit(0.05))
             .cast("decimal(9,3)").alias("weight_per_unit"),
            (q * 20).cast("decimal(12,2)").alias("qty"),
            F.when(ln == 7, q * 20).when(ln == 6, F.lit(10.0)).otherwise(F.lit(0.0))
             .cast("decimal(12,2)").alias("delivered_qty"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("rate"),
            F.when(F.col("l_returnflag") == "A", "VAT16").otherwise("EXEMPT")
             .alias("item_tax_template"))

    # -- purchases -----------------------------------------------------------
    def _orders_with_supplier(self) -> DataFrame:
        sup = self.raw("supplier").select(
            _name("SUP-", "s_suppkey").alias("_sname"), "s_name")
        return self._ranged(self._orders.join(sup, F.col("sup") == F.col("_sname")), "d", "k")

    @cached_property
    def purchase_invoice(self) -> DataFrame:
        k, amt, sup = F.col("k"), F.col("amt"), F.col("sup")
        last = F.substring(sup, -1, 1)
        return self._orders_with_supplier().select(
            _name("PI-", k).alias("name"),
            sup.alias("supplier"),
            F.col("s_name").alias("supplier_name"),
            F.col("d").alias("posting_date"),
            F.date_add("d", 30).alias("due_date"),
            amt.alias("base_grand_total"),
            F.when(last.isin("3", "7"), amt * F.lit(0.1).cast("decimal(1,1)")).otherwise(amt)
             .cast("decimal(18,2)").alias("outstanding_amount"),
            F.col("cur").alias("party_account_currency"),
            F.when(F.col("cur") == "USD", F.lit(1.25)).otherwise(F.lit(1))
             .cast("decimal(9,4)").alias("conversion_rate"),
            F.when(k % 5 == 0, "Paid").when(k % 5 == 1, "Return")
             .otherwise("Unpaid").alias("status"),
            F.when(k % 5 == 1, 1).otherwise(0).alias("is_return"),
            self._docstatus().alias("docstatus"))

    @cached_property
    def purchase_invoice_item(self) -> DataFrame:
        part = self.raw("part").select("p_partkey", "p_name", "p_type")
        return self.raw("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            _name("PI-", "l_orderkey").alias("parent"),
            _name("ITM-", "l_partkey").alias("item_code"),
            F.col("p_name").alias("item_name"),
            F.col("p_type").alias("item_group"),
            F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("rate"),
            F.when(F.col("l_linenumber") % 2 == 0, "BAG").otherwise("KG").alias("uom"))

    # -- journals and payments ----------------------------------------------
    @cached_property
    def journal_entry(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self._ranged(self.raw("orders").where(k % 4 < 2), "o_orderdate", "o_orderkey").select(
            _name("JE-", k).alias("name"),
            F.col("o_orderdate").cast("date").alias("posting_date"),
            F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("docstatus"),
            F.when(k % 8 == 0, 1).otherwise(0).alias("is_system_generated"))

    @cached_property
    def journal_entry_account(self) -> DataFrame:
        ln, pk, price = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_extendedprice")
        zero = F.lit(0.0)
        return self.raw("lineitem").select(
            _name("JE-", "l_orderkey").alias("parent"),
            F.concat(F.lit("JEA-"), _s("l_orderkey"), F.lit("-"), _s(pk)).alias("name"),
            F.when(pk % 6 == 0, "Customer").otherwise("Supplier").alias("party_type"),
            _name("SUP-", "l_suppkey").alias("party"),
            _name("ACC-", pk % 25).alias("account"),
            F.when(ln.isin(3, 4, 5), price).otherwise(zero).cast("decimal(18,2)").alias("debit"),
            F.when(ln.isin(1, 2), price).otherwise(zero).cast("decimal(18,2)").alias("credit"),
            F.when(ln == 4, "Journal Entry").when(ln == 5, "Purchase Invoice")
             .otherwise(F.lit(None).cast("string")).alias("reference_type"),
            F.when(ln.isin(2, 4, 5) & (pk % 3 == 0), "REF")
             .otherwise(F.lit(None).cast("string")).alias("reference_name"),
            F.lit(1).alias("docstatus"))

    @cached_property
    def payment_entry(self) -> DataFrame:
        k, amt = F.col("k"), F.col("amt")
        return self._orders_with_supplier().select(
            _name("PE-", k).alias("name"),
            F.when(k % 3 == 0, "Receive").otherwise("Pay").alias("payment_type"),
            F.col("d").alias("posting_date"),
            F.when(k % 7 == 0, "Customer").otherwise("Supplier").alias("party_type"),
            F.col("sup").alias("party"),
            F.col("s_name").alias("party_name"),
            amt.alias("base_paid_amount"),
            F.when(k % 4 == 0, amt).otherwise(amt * F.lit(0.5).cast("decimal(1,1)"))
             .cast("decimal(18,2)").alias("base_total_allocated_amount"),
            self._docstatus().alias("docstatus"))

    @cached_property
    def payment_entry_reference(self) -> DataFrame:
        return self.raw("lineitem").select(
            _name("PE-", "l_orderkey").alias("parent"),
            F.when(F.col("l_returnflag") == "A", "Journal Entry")
             .otherwise("Purchase Invoice").alias("reference_doctype"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("allocated_amount"))

    # -- general ledger ----------------------------------------------------
    @cached_property
    def gl_entry(self) -> DataFrame:
        """Seven kinds of ledger entries per order, generated in one scan.

        Each order yields up to seven entries (purchase invoice, payment,
        customer receipt, supplier payment, journal, sales invoice, purchase
        invoice expense), each kept or not by its own rule; the entries are
        an array of structs exploded with ``inline``, so ``orders`` is read
        once instead of once per kind.
        """
        k, amt, sup, cust = F.col("k"), F.col("amt"), F.col("sup"), F.col("cust")
        null_s = F.lit(None).cast("string")
        zero = F.lit(0)
        always = F.lit(True)

        def entry(keep, prefix, account, party_type, party, debit, credit, against,
                  voucher_type, voucher_subtype):
            return F.struct(
                keep.alias("keep"),
                _name(prefix, k).alias("name"),
                account.cast("string").alias("account"),
                party_type.cast("string").alias("party_type"),
                party.cast("string").alias("party"),
                debit.cast("decimal(18,2)").alias("debit"),
                credit.cast("decimal(18,2)").alias("credit"),
                against.cast("string").alias("against"),
                F.lit(voucher_type).alias("voucher_type"),
                voucher_subtype.cast("string").alias("voucher_subtype"))

        acc_k5 = _name("ACC-", (k % 5) * 5)
        last_is_7 = F.substring(sup, -1, 1) == "7"
        sub4 = (F.when(k % 4 == 0, "Journal Entry")
                 .when(k % 4 == 2, "Internal Transfer"))
        entries = F.array(
            entry(always, "A-", acc_k5, F.lit("Supplier"), sup, zero, amt, null_s,
                  "Purchase Invoice", F.lit("Purchase Invoice")),
            entry(k % 20 != 3, "B-", acc_k5, F.lit("Supplier"), sup,
                  F.when(last_is_7, amt * 2).otherwise(amt * F.lit(0.5).cast("decimal(1,1)")),
                  zero, null_s, "Payment Entry", F.lit("Pay")),
            entry(always, "C-", F.when(k % 2 == 0, "ACC-2").otherwise("ACC-3"),
                  F.lit("Customer"), cust, amt, zero, cust, "Payment Entry",
                  sub4.otherwise("Receive")),
            entry(k % 7 != 0, "D-", F.when(k % 2 == 0, "ACC-7").otherwise("ACC-8"),
                  F.lit("Supplier"), sup, zero, amt * F.lit(0.8).cast("decimal(1,1)"), sup,
                  "Payment Entry", sub4.otherwise("Pay")),
            entry(k % 3 == 1, "E-", F.when(k % 5 == 1, "ACC-22").otherwise("ACC-12"),
                  null_s, null_s, zero, amt,
                  F.when(k % 11 == 0, null_s).otherwise(_name("ACC-", k % 25)),
                  "Journal Entry",
                  F.when(k % 6 == 0, "Internal Transfer").otherwise("Journal Entry")),
            entry(always, "F-", F.when(k % 3 == 0, "ACC-4").when(k % 3 == 1, "ACC-14")
                  .otherwise("ACC-24"), null_s, null_s, zero, amt, null_s,
                  "Sales Invoice", F.lit("Sales Invoice")),
            entry(k % 5 != 0, "G-", F.when(k % 2 == 0, "ACC-9").otherwise("ACC-19"),
                  null_s, null_s, amt * F.lit(0.6).cast("decimal(1,1)"), zero, null_s,
                  "Purchase Invoice", F.lit("Purchase Invoice")),
        )
        gl = self._with_names(self._ranged(self._order_rows, "d", "k")).select(
            F.col("d").alias("posting_date"), F.col("cur").alias("transaction_currency"),
            F.col("canc").alias("is_cancelled"),
            F.inline(F.filter(entries, lambda e: e["keep"])))
        # Columns the test tables do not carry (FIXTURES.md §3 note).
        return gl.select(
            "name", "posting_date", "account", "party_type", "party", "debit", "credit",
            "against", "voucher_type", "voucher_subtype", "transaction_currency",
            "is_cancelled",
            F.col("name").alias("voucher_no"),
            null_s.alias("against_voucher_type"),
            null_s.alias("against_voucher"),
            F.col("debit").alias("debit_in_transaction_currency"),
            F.col("credit").alias("credit_in_transaction_currency"))


# Landing layout of tables that are not ``dealt``: headers clustered by their
# date (with the unique name so a busy day can be split), lines spread evenly.
LAYOUT = {
    "gl_entry": ("range", ("posting_date", "name")),
    "sales_invoice": ("range", ("posting_date", "name")),
    "purchase_invoice": ("range", ("posting_date", "name")),
    "sales_order": ("range", ("transaction_date", "name")),
    "journal_entry": ("range", ("posting_date", "name")),
    "payment_entry": ("range", ("posting_date", "name")),
    "sales_invoice_item": ("spread", ()),
    "sales_order_item": ("spread", ()),
    "purchase_invoice_item": ("spread", ()),
    "journal_entry_account": ("spread", ()),
    "payment_entry_reference": ("spread", ()),
    "sales_team": ("spread", ()),
    "delivery_note": ("spread", ()),
}

_LANDED: dict[tuple[str, str], "LandedTables"] = {}
_LANDING_LOCK = threading.RLock()


def landed_testbed(spark: SparkSession, sf_dir: str) -> "LandedTables":
    """The ERP tables of ``sf_dir`` landed as Parquet, each when it is first
    asked for and once per application.

    This is the extraction step of the source system: a derived table is
    written under the shared folder (``spark.checkpoint.dir``) and every
    report reads the landed files, so the reports' plans start at Parquet
    scans with real sizes and the lineage to the raw tables is cut. Inputs
    are taken as they are at that time.
    """
    from ..session import application_id, scratch_path

    key = (application_id(spark), sf_dir.rstrip("/"))
    with _LANDING_LOCK:
        if key not in _LANDED:
            _LANDED[key] = LandedTables(spark, scratch_path(spark, "erp-landing"),
                                        ErpTables(spark, sf_dir, dealt=True))
        return _LANDED[key]


class LandedTables:
    """ERP tables read from a landing folder (one Parquet dataset each); a
    table that ``derived`` can make is landed when it is first asked for."""

    def __init__(self, spark: SparkSession, root: str, derived: ErpTables | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.derived = derived

    def __getattr__(self, name: str) -> DataFrame:
        from .extract import land_tables

        if name not in ERP_TABLES:
            raise AttributeError(name)
        with _LANDING_LOCK:
            if name not in self.__dict__:
                if self.derived is not None:
                    land_tables(self.derived, self.root, [name],
                                layout=None if self.derived.dealt else LAYOUT)
                self.__dict__[name] = self.spark.read.parquet(f"{self.root}/{name}")
        return self.__dict__[name]


def register_views(tables, prefix: str = "erp_") -> list[str]:
    """Register every ERP table as a temp view (``erp_gl_entry``, ...), so
    ad-hoc SQL with bound parameters (``spark.sql(q, args=...)``) runs over
    the same tables as the reports."""
    names = []
    for n in ERP_TABLES:
        getattr(tables, n).createOrReplaceTempView(f"{prefix}{n}")
        names.append(f"{prefix}{n}")
    return names
