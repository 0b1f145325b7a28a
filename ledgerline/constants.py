"""Business constants of the ERP reports.

Everything a deployment may change (dates, company name, account names,
targets, tax templates) is a function argument instead.
"""

from __future__ import annotations

from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values. These must equal the report definitions for right results.
# ---------------------------------------------------------------------------

# Document states.
SUBMITTED = 1
NOT_CANCELLED = 0
NOT_SYSTEM_GENERATED = 0
NOT_RETURN = 0
NOT_OPENING = "No"

# Party and voucher types.
PARTY_SUPPLIER = "Supplier"
PARTY_CUSTOMER = "Customer"
PAYMENT_PAY = "Pay"
DOCTYPE_JOURNAL_ENTRY = "Journal Entry"
DOCTYPE_PURCHASE_INVOICE = "Purchase Invoice"
SUBTYPES_RECEIPT = ("Journal Entry", "Receive")
SUBTYPES_PAYMENT = ("Journal Entry", "Pay")
SUBTYPES_NOT_DRAWING = ("Internal Transfer",)

# Account classification.
ACCOUNT_PAYABLE = "Payable"
CASH_ACCOUNT_TYPES = ("Bank", "Cash")
ROOT_INCOME = "Income"
ROOT_EXPENSE = "Expense"
PAYROLL_PARENT_PATTERN = "%Payroll%"

# Invoice states.
INVOICE_STATUS_CLOSED = ("Paid", "Return")
INVOICE_STATUS_RETURN = ("Return",)

# Sales order rules.
ORDER_STATUS_CLOSED = ("Closed", "Completed", "On Hold")
MAX_PERCENT_DELIVERED = 60
TRANSPORT_ITEM = "SRV-001"
DELIVERY_WINDOW_DAYS = 7
DELIVERY_WINDOW_DAYS_BY_ORDER = 14
TARGET_DAYS_FIXED = 31
RAW_MATERIALS_GROUP = "RAW MATERIALS"

# Currency conversion: only this currency is converted with conversion_rate.
FOREIGN_CURRENCY = "USD"

# Tax-inclusive rate factor.
TAX_FACTOR = Decimal("1.16")

# Truck-load ladder, first match wins; otherwise the remaining quantity.
# (minimum qty, exact qty, weight per unit, currency, bags)
LOAD_LADDER = (
    (680, None, Decimal("0.025"), "KES", 680),
    (680, None, Decimal("0.025"), "USD", 680),
    (None, 480, Decimal("0.025"), None, 480),
    (340, None, None, "KES", 340),
    (560, None, None, "USD", 560),
)

# Accounts-payable ageing buckets in days after the due date (inclusive).
AGEING_BUCKETS = (
    ("0-30", 0, 30),
    ("31-60", 31, 60),
    ("61-90", 61, 90),
    ("91-120", 91, 120),
    ("121-Above", 121, None),
)

# Report labels.
LABEL_COLLECTIONS = "Cash From Collections"
LABEL_OUTFLOW = "Cash Outflow"
LABEL_DRAWINGS = "Other drawings"
LABEL_SALARY = "Salary Payment"
LABEL_SUPPLIER_PAYMENT = "Supplier Payment"
LABEL_BALANCE = "Balance/Deficit"
LABEL_NET_PROFIT = "Net Profit"
LABEL_POTENTIAL = "Potential Deliveries"
LABEL_SALES_TODAY = "Sales Today"
LABEL_SALES_TARGET = "Sales Target"
LABEL_TOTALS = "TOTALS"
LABEL_SALES_TARGET_TODAY = "Sales Target Today"

# ---------------------------------------------------------------------------
# Numeric types used across the library (SEM-17: money is summed exactly).
# ---------------------------------------------------------------------------
MONEY = "decimal(18,2)"
WIDE_MONEY = "decimal(38,6)"
TARGET = "decimal(20,4)"
