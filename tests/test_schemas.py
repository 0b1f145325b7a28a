"""Star-schema DDL (CAT-1) and load checks (DQ-1..4)."""

import datetime as dt

from ledgerline import schemas as S


def test_create_tables_if_not_exists(spark, tmp_dir):
    assert S.create_tables(spark, tmp_dir) == list(S.TABLES)
    assert S.create_tables(spark, tmp_dir) == list(S.TABLES)     # idempotent
    cols = [f.name for f in spark.table("purchase_history").schema.fields]
    assert cols == [f.name for f in S.PURCHASE_HISTORY.fields]
    assert spark.table("customers").count() == 0


def test_load_checks_and_defaults(spark):
    customers = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")],
                                      "customer_id int, customer_name string")
    channels = spark.createDataFrame([(1, "web")], "channel_id int, channel_name string")
    ph = spark.createDataFrame(
        [(1, 10, 1, 2, None, dt.datetime(2026, 1, 1)), (3, 10, 9, 1, 0.5, None)],
        "customer_id int, product_sku int, channel_id int, quantity int, discount double, "
        "order_date timestamp_ntz")
    pk = S.load_checks("customers", customers, {})["pk_violations"].collect()
    assert [(r.customer_id, r.n_rows) for r in pk] == [(1, 2)]
    checks = S.load_checks("purchase_history", ph,
                           {"customers": customers, "channels": channels})
    assert checks["fk_orphans:customer_id"].count() == 1
    assert checks["fk_orphans:channel_id"].count() == 1
    assert "fk_orphans:product_sku" not in checks
    nn = {r.column_name: r.null_rows for r in checks["not_null_violations"].collect()}
    assert nn == {"order_date": 1}
    filled = S.with_defaults("purchase_history", ph, load_time=dt.datetime(2026, 7, 1))
    rows = filled.orderBy("customer_id").collect()
    assert rows[0].discount == 0.0 and rows[1].discount == 0.5
    assert rows[0].created_at == dt.datetime(2026, 7, 1)
