"""Uniqueness against the keys of earlier windows."""

import datetime as dt
import shutil

from tessera.operators.history import KeyHistory, repeated_rows, uniqueness_failures

HOURS = [dt.datetime(2024, 5, 1, h) for h in range(4)]


def window(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, n int")


def failures(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_repeats_are_found_without_the_earlier_rows(spark, tmp_dir):
    first = f"{tmp_dir}/first"
    window(spark, [(1, "a", 1), (2, "b", 1), (3, "a", 1), (4, None, 1)]).write.parquet(first)
    known = KeyHistory(spark, f"{tmp_dir}/keys", 4)
    rows = spark.read.parquet(first)
    assert failures(uniqueness_failures(rows, ["k"], ["id"], known, HOURS[0])) == [("1", "a", "window"), ("3", "a", "window")]
    known.remember(rows, ["k"], HOURS[0])
    shutil.rmtree(first)
    second = window(spark, [(5, "a", 1), (6, "c", 1), (7, "c", 2), (8, None, 1), (9, "b", 1), (10, "b", 1)])
    want = [("10", "b", "window, history"), ("5", "a", "history"), ("6", "c", "window"), ("7", "c", "window"), ("9", "b", "window, history")]
    assert failures(uniqueness_failures(second, ["k"], ["id"], known, HOURS[1])) == want
    known.remember(second, ["k"], HOURS[1])
    # Judged again the window does not find itself, and remembering it again adds nothing.
    assert failures(uniqueness_failures(second, ["k"], ["id"], known, HOURS[1])) == want
    before = known.keys().count()
    known.remember(second, ["k"], HOURS[1])
    assert known.keys().count() == before == 3
    # A later session names the same files.
    known.forget_name()
    again = KeyHistory(spark, f"{tmp_dir}/keys", 4)
    assert failures(uniqueness_failures(window(spark, [(11, "c", 0), (12, "d", 0)]), ["k"], ["id"], again, HOURS[2])) == [("11", "c", "history")]


def test_composite_and_empty_keys(spark, tmp_dir):
    known = KeyHistory(spark, f"{tmp_dir}/keys", 2)
    known.remember(window(spark, [(1, "a", 1), (2, None, 2), (3, "", 3)]), ["k", "n"], HOURS[0])
    rows = window(spark, [(4, "a", 1), (5, "a", 2), (6, None, 2), (7, "", 3)])
    assert sorted(r.id for r in repeated_rows(rows, ["k", "n"], known, HOURS[1]).collect()) == [4, 7]
    known.remember(rows.limit(0), ["k", "n"], HOURS[1])
    assert known.keys().count() == 2


def test_history_is_joined_by_its_buckets(spark, tmp_dir):
    known = KeyHistory(spark, f"{tmp_dir}/keys", 4)
    known.remember(spark.range(1000).selectExpr("CAST(id AS int) id"), ["id"], HOURS[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = repeated_rows(spark.range(500, 1500).selectExpr("CAST(id AS int) id"), ["id"], known, HOURS[1])
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 4 out of 4" in plan and plan.count("Exchange hashpartitioning") == 1
        assert rows.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
