"""Operators against brute force on generated small inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators.aggregates import grouped_with_text_max, latest_per_key

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]),
              st.one_of(st.none(), st.integers(0, 5)),
              st.one_of(st.none(), st.integers(-3, 3))),
    min_size=0, max_size=25)


def _key(v):
    # Spark orders NULL below every value (ascending), as max() does
    return (v is not None, v if v is not None else 0)


@settings(max_examples=25, deadline=None)
@given(rows_strategy)
def test_latest_per_key_is_the_max_by_order_then_payload(spark, rows):
    df = spark.createDataFrame(rows, "k string, m int, v int")
    got = {r.k: (r.m, r.v) for r in latest_per_key(df, ["k"], ["m"]).collect()}
    expected = {}
    for k, m, v in rows:
        if k not in expected or (_key(m), _key(v)) > (_key(expected[k][0]), _key(expected[k][1])):
            expected[k] = (m, v)
    assert got == expected


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.sampled_from(["p", "q", None]),
                          st.one_of(st.none(), st.integers(-5, 5))), max_size=25))
def test_grouped_text_max_equals_plain_aggregate(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "k string, t string, v int")
    got = grouped_with_text_max(df, ["k"], ["t"], {"s": ("sum", F.col("v")),
                                                   "m": ("max", F.col("v"))})
    plain = df.groupBy("k").agg(F.max("t").alias("t"), F.sum("v").alias("s"),
                                F.max("v").alias("m"))
    assert sorted(map(tuple, got.select("k", "t", "s", "m").collect())) == \
        sorted(map(tuple, plain.select("k", "t", "s", "m").collect()))


@settings(max_examples=20, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d"]),
                       st.one_of(st.none(), st.integers(-9, 9)), max_size=4))
def test_detail_and_total_is_detail_plus_its_sum(spark, detail_rows):
    from pyspark.sql import functions as F

    from ledgerline.operators.aggregates import detail_and_total

    df = spark.createDataFrame(list(detail_rows.items()), "k string, v int")
    out = detail_and_total(df, ["k"], ["v"], {"k": F.lit("TOTAL")},
                           {"v": lambda c: c * 10}).collect()
    got = sorted((r.k, r.v) for r in out)
    values = [v for v in detail_rows.values() if v is not None]
    total = sum(values) * 10 if values else None
    assert got == sorted([*detail_rows.items(), ("TOTAL", total)])
