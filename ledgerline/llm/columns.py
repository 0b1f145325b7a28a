"""Column helpers shared by the DataFrame-only operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of the word rule ``[^\x20\x09-\x0D]+``.
BLANKS = r"[\x20\x09-\x0D]"
# Everything that is not part of a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also when ``body`` uses
    it inside a lambda (where a plain expression would run per element)."""
    return F.transform(F.array(value), body)[0]


def blank_words(text: Column) -> Column:
    """Words between blanks, as an array; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), "")


def plain_words(text: Column) -> Column:
    """Lower-cased (A-Z only) letter and digit words, as an array."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NON_WORD), "")


def n_blank_words(text: Column) -> Column:
    """Number of words between blanks without building them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
