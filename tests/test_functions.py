"""Column helpers on hand-made rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline import constants as C
from ledgerline.functions import columns as X


def test_week_sunday_examples(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2026, 1, 1),),
                                (dt.date(2026, 1, 4),), (dt.date(2024, 12, 31),)], "d date")
    got = [r[0] for r in df.select(X.week_sunday("d")).collect()]
    assert got == [1, 0, 1, 52]


def test_week_sunday_equals_strftime_u_over_36_years(spark):
    days = spark.range(1).select(F.explode(F.sequence(F.lit(dt.date(1995, 1, 1)),
                                                      F.lit(dt.date(2030, 12, 31)))).alias("d"))
    got = {r.d: r.w for r in days.select("d", X.week_sunday("d").alias("w")).collect()}
    assert len(got) == 13149
    assert all(w == int(d.strftime("%U")) for d, w in got.items())


def _ladder_py(q, w, cur):
    for min_q, exact_q, weight, c, bags in C.LOAD_LADDER:
        if min_q is not None and not q >= min_q:
            continue
        if exact_q is not None and q != exact_q:
            continue
        if weight is not None and w != weight:
            continue
        if c is not None and cur != c:
            continue
        return Decimal(bags)
    return q


def test_load_ladder_grid(spark):
    rows = [(Decimal(q), Decimal(w), cur)
            for q in (339, 340, 479, 480, 481, 559, 560, 679, 680)
            for cur in ("KES", "USD") for w in ("0.025", "0.050")]
    df = spark.createDataFrame(rows, "q decimal(12,2), w decimal(9,3), cur string")
    got = df.select("q", "w", "cur", X.load_ladder("q", "w", "cur").alias("b")).collect()
    for r in got:
        assert r.b == _ladder_py(r.q, r.w, r.cur), r
    # spot checks of the first-match order
    lookup = {(int(r.q), str(r.w), r.cur): int(r.b) for r in got}
    assert lookup[(680, "0.025", "USD")] == 680
    assert lookup[(680, "0.050", "USD")] == 560
    assert lookup[(480, "0.025", "USD")] == 480
    assert lookup[(480, "0.050", "USD")] == 480   # below 560, not exact-480 weight
    assert lookup[(481, "0.025", "USD")] == 481
    assert lookup[(339, "0.050", "KES")] == 339
    assert lookup[(340, "0.050", "KES")] == 340
    assert lookup[(679, "0.025", "KES")] == 340


def test_first_non_blank(spark):
    rows = [(None, None, None), ("", "", ""), ("A", None, None), ("", "B", None),
            ("", None, "C"), (None, "B", "C"), ("A", "B", "C")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(X.first_non_blank("a", "b", "c")).collect()]
    assert got == [None, None, "A", "B", "C", "B", "A"]


def test_tax_per_item(spark):
    rows = [(Decimal("0"), Decimal("5")), (Decimal("10"), Decimal("0")),
            (Decimal("10"), Decimal("4")), (None, Decimal("4"))]
    df = spark.createDataFrame(rows, "tax decimal(18,2), qty decimal(18,2)")
    got = [r[0] for r in df.select(X.tax_per_item("tax", "qty")).collect()]
    assert got == [0.0, None, 2.5, 0.0]


def test_daily_target_four_places(spark):
    df = spark.range(1).select(X.daily_target(135000000, 31).alias("t"),
                               X.daily_target(135000000, 29).alias("u"))
    r = df.first()
    assert r.t == Decimal("4354838.7097")
    assert r.u == Decimal("4655172.4138")


def test_currency_and_tax_rate(spark):
    df = spark.createDataFrame([(Decimal("10.00"), "USD", Decimal("129.5"), "VAT16"),
                                (Decimal("10.00"), "KES", Decimal("1"), "EXEMPT")],
                               "r decimal(12,2), cur string, cr decimal(9,4), tpl string")
    got = df.select(X.tax_inclusive_rate("r", "tpl", "VAT16").alias("t"),
                    X.convert_currency("r", "cur", "cr").alias("c")).collect()
    assert got[0].t == Decimal("11.60") and got[1].t == Decimal("10.00")
    assert got[0].c == Decimal("1295.000000") and got[1].c == Decimal("10.00")


def test_ratio_divides_by_zero_to_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(X.ratio("a", "b")).collect()] == [None, 0.25]
