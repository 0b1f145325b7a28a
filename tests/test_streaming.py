"""Incremental landing with Structured Streaming (SRC-4 + MRG-1)."""

import datetime as dt

from ledgerline.streaming.increments import current_rows, pull_to_folder, stream_increments

SCHEMA = "name string, modified timestamp, amount int"


def test_overlapping_pulls_land_once_and_latest_wins(spark, tmp_dir):
    pulls, history, ckpt = f"{tmp_dir}/pulls", f"{tmp_dir}/history", f"{tmp_dir}/ckpt"
    t1, t2, t3 = (dt.datetime(2026, 7, d) for d in (1, 2, 3))
    first = spark.createDataFrame([("A", t1, 1), ("B", t1, 2), ("C", t2, 3)], SCHEMA)
    # second pull overlaps the first: B and C again unchanged, A changed, D new
    second = spark.createDataFrame([("A", t3, 10), ("B", t1, 2), ("C", t2, 3), ("D", t3, 4)],
                                   SCHEMA)
    pull_to_folder(first, pulls, "2026-07-01")
    pull_to_folder(second, pulls, "2026-07-02")
    q = stream_increments(spark, pulls, first.schema, history, checkpoint_dir=ckpt)
    q.awaitTermination()
    landed = spark.read.parquet(history)
    assert landed.count() == 7                    # every row of every pull
    got = {r.name: r.amount for r in current_rows(spark, history, ["name"]).collect()}
    assert got == {"A": 10, "B": 2, "C": 3, "D": 4}

    # a restart with the same checkpoint reads only the new pull
    third = spark.createDataFrame([("B", t3, 20)], SCHEMA)
    pull_to_folder(third, pulls, "2026-07-03")
    q = stream_increments(spark, pulls, first.schema, history, checkpoint_dir=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(history).count() == 8
    got = {r.name: r.amount for r in current_rows(spark, history, ["name"]).collect()}
    assert got == {"A": 10, "B": 20, "C": 3, "D": 4}


def test_a_change_without_a_new_timestamp_is_kept(spark, tmp_dir):
    pulls, history = f"{tmp_dir}/pulls", f"{tmp_dir}/history"
    t1 = dt.datetime(2026, 7, 1)
    for ds, amount in (("2026-07-01", 1), ("2026-07-02", 9)):
        pull_to_folder(spark.createDataFrame([("k1", t1, amount)], SCHEMA), pulls, ds)
        q = stream_increments(spark, pulls, spark.createDataFrame([], SCHEMA).schema, history,
                              checkpoint_dir=f"{tmp_dir}/ckpt")
        q.awaitTermination()
    rows = current_rows(spark, history, ["name"])
    assert [tuple(r) for r in rows.collect()] == [("k1", t1, 9)]
