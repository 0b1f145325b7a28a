"""Column helpers: the scalar rules of the reports as built-in expressions.

Every helper returns a ``Column`` made of ``pyspark.sql.functions`` only, so
it stays inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

ColumnOrName = Column | str
DateLike = _dt.date | str | Column


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d: DateLike) -> Column:
    """A date parameter as a typed literal (SEM-7: dates compare as dates)."""
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def as_of_or_today(as_of: DateLike | None) -> Column:
    """FN-8: the report date; the wall clock only when none is given."""
    return F.current_date() if as_of is None else date_lit(as_of)


def money(c: ColumnOrName) -> Column:
    """Final money output: exact decimal sums are turned into double once."""
    return col(c).cast("double")


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """SEM-4: x / 0 is NULL. Ratios are computed in double precision."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def null_of(type_name: str) -> Column:
    """SEM-3: a blank in a number/date column of a summary row is NULL."""
    return F.lit(None).cast(type_name)


def first_non_blank(*cols: ColumnOrName) -> Column:
    """FN-4: first argument that is neither NULL nor the empty string."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in cols))


def week_sunday(d: ColumnOrName) -> Column:
    """FN-10: week number with weeks starting on Sunday, 0-53.

    Days before the year's first Sunday are week 0 (MySQL ``WEEK(d, 0)``,
    ``%U`` in strftime). ``dayofweek`` is 1 for Sunday.
    """
    d = col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def month_start(d: DateLike) -> Column:
    """FN-14: first day of the month."""
    return F.trunc(date_lit(d), "MM")


def days_in_month(d: DateLike) -> Column:
    """FN-12: ``DAY(LAST_DAY(d))``."""
    return F.dayofmonth(F.last_day(date_lit(d)))


def daily_target(monthly_target: int | Decimal, days: Column | int) -> Column:
    """FN-23: monthly target spread evenly over the days.

    Integer division in the source database yields four decimal places; the
    result is kept as an exact decimal so running sums do not drift.
    """
    days_col = days if isinstance(days, Column) else F.lit(days)
    return F.round(
        F.lit(monthly_target).cast("decimal(20,0)") / days_col.cast("decimal(10,0)"), 4
    ).cast(C.TARGET)


def convert_currency(amount: ColumnOrName, currency: ColumnOrName,
                     rate: ColumnOrName, foreign: str = C.FOREIGN_CURRENCY) -> Column:
    """FN-18: only the foreign currency is multiplied by its conversion rate."""
    return F.when(col(currency) == foreign, col(amount) * col(rate)).otherwise(col(amount))


def tax_inclusive_rate(rate: ColumnOrName, template: ColumnOrName, taxed_template: str,
                       factor: Decimal = C.TAX_FACTOR) -> Column:
    """FN-19: rate with tax, rounded to 2 places, for the one taxed template."""
    factor_lit = F.lit(factor).cast(f"decimal({len(factor.as_tuple().digits)},"
                                    f"{-factor.as_tuple().exponent})")
    return (F.when(col(template) == taxed_template, F.round(col(rate) * factor_lit, 2))
             .otherwise(col(rate)))


def tax_per_item(tax: ColumnOrName, qty: ColumnOrName) -> Column:
    """FN-20: header tax spread over the header quantity; 0 without tax."""
    return F.when(col(tax) != 0, ratio(tax, qty)).otherwise(F.lit(0.0))


def _ladder_rules(qty: ColumnOrName, weight: ColumnOrName, currency: ColumnOrName,
                  rules: Iterable[tuple]) -> list[tuple[Column, int]]:
    out = []
    for min_qty, exact_qty, w, cur, bags in rules:
        cond = F.lit(True)
        if min_qty is not None:
            cond = cond & (col(qty) >= min_qty)
        if exact_qty is not None:
            cond = cond & (col(qty) == exact_qty)
        if w is not None:
            cond = cond & (col(weight) == F.lit(w))
        if cur is not None:
            cond = cond & (col(currency) == cur)
        out.append((cond, bags))
    return out


def _first_match(pairs: list[tuple[Column, Column]], default: Column) -> Column:
    expr = None
    for cond, value in pairs:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return default if expr is None else expr.otherwise(default)


def load_ladder(qty: ColumnOrName, weight: ColumnOrName, currency: ColumnOrName,
                rules: Iterable[tuple] = C.LOAD_LADDER) -> Column:
    """FN-21: truck-load rounding; the first matching rule wins."""
    pairs = [(cond, F.lit(bags)) for cond, bags in _ladder_rules(qty, weight, currency, rules)]
    return _first_match(pairs, col(qty))


def load_rung(qty: ColumnOrName, weight: ColumnOrName, currency: ColumnOrName,
              rules: Iterable[tuple] = C.LOAD_LADDER) -> Column:
    """Index (1-based) of the ladder rule that fires; 0 when none does."""
    pairs = [(cond, F.lit(i)) for i, (cond, _) in
             enumerate(_ladder_rules(qty, weight, currency, rules), start=1)]
    return _first_match(pairs, F.lit(0))


def in_bucket(days: ColumnOrName, lo: int, hi: int | None) -> Column:
    """FN-22: inclusive ageing bucket test on integer days."""
    c = col(days)
    return c >= lo if hi is None else c.between(lo, hi)


def is_salary_account(parent: ColumnOrName, payroll_parent: str) -> Column:
    """FN-25: a payment is a salary payment when the party account's parent
    is exactly the payroll parent account (otherwise a supplier payment)."""
    return col(parent) == payroll_parent
