"""The commit log (S11, W3), counts at write (B3) and isolation on the file path."""

import datetime as dt
import os

import pytest

from tessera.clock import RunClock
from tessera.operators import sqlrules
from tessera.plans import commits, runner
from tessera.plans.catalog import Catalog, group_plan, rule_plan
from tessera.sources.sinks import Counting, write_results
from tessera.streaming import arrivals

NOON, LATER = RunClock(dt.datetime(2024, 1, 15, 12)), RunClock(dt.datetime(2024, 1, 15, 13))


def catalog(spark):
    rules = [(1, "present", '{"is_nullable": "NO"}', "Custodial"), (2, "unique", '{"distinct": true}', "Custodial"),
             (3, "not negative", '{"min": 0}', "Custodial"), (4, "nonsense", '{"no such key": 1}', "Custodial")]
    objects = [(i, name, "db", None, key, "full table", None, None, 1)
               for i, name, key in ((1, "good", "id"), (2, "other", "id"), (3, "keyless", "no_such_key"), (4, "unruled", "id"))]
    mappings = [(11, 1, 1, "v"), (12, 1, 2, "id"), (13, 1, 3, "v"), (21, 2, 3, "v"), (31, 3, 1, "v"), (41, 4, 4, "v")]
    return Catalog.from_rows(
        spark, rule=rules, object_lookup=objects, rule_mapping=[(*m, None, None, "Custodial", 1) for m in mappings],
        rule_threshold=[(i, m[0], 0.0, 1, 1) for i, m in enumerate(mappings)], handler=[(1, "look")], distribution=[(1, "a@b.invalid")],
        notification=[(1, 1, 1)], object_notification=[(i, i, 1, 1) for i in (1, 2)])


def go(spark, out, rows, clock=NOON, objects=(1, 2), **options):
    frames = {n: spark.createDataFrame(r, "id int, v double") for n, r in rows.items()}
    return runner.run(spark, catalog(spark), lambda p: frames[p.object_name], out, clock=clock, object_ids=list(objects), **options)


def seen(spark, out, table="detailed"):
    return sorted((r.Object_ID, r.Mapping_ID, r.Primary_Key_Value_s_) for r in runner.read_result(spark, out, table).collect())


BAD = {"good": [(1, None), (2, -1.0), (2, 3.0)], "other": [(7, -5.0), (8, 1.0)]}
FOUND = [(1, 11, "1"), (1, 12, "2"), (1, 12, "2"), (1, 13, "2"), (2, 21, "7")]


def test_a_rerun_replaces_also_where_it_finds_nothing(spark, tmp_dir):
    go(spark, tmp_dir, BAD)
    assert seen(spark, tmp_dir) == FOUND
    go(spark, tmp_dir, {"good": [(1, 1.0), (2, 1.0)], "other": [(9, -1.0)]}, LATER)
    assert seen(spark, tmp_dir) == [(2, 21, "9")]
    counts = {r.Mapping_ID: (r.Failure_Count, r.Criticality) for r in runner.read_result(spark, tmp_dir, "aggregated").collect()}
    assert counts == {11: (0, None), 12: (0, None), 13: (0, None), 21: (1, 1)}
    assert [r.Object_ID for r in runner.read_result(spark, tmp_dir, "alerts").collect()] == [2]
    assert [r.Contact_email for r in runner.read_result(spark, tmp_dir, "alert_recipients").collect()] == ["a@b.invalid"]
    assert len(runner.read_result(spark, tmp_dir, "object_log").collect()) == 2
    # The replaced folder of object 1 has no successor in this table: unseen, and gone after a vacuum.
    folders = [f for f in os.listdir(f"{tmp_dir}/detailed/Period=2024-01-15") if f.startswith("Object_ID")]
    assert sorted(folders) == ["Object_ID=1", "Object_ID=2"]
    gone = commits.vacuum(spark, tmp_dir, dt.datetime(2100, 1, 1))
    assert gone and all("Object_ID=1" in g or "alert" in g for g in gone) and seen(spark, tmp_dir) == [(2, 21, "9")]
    assert commits.vacuum(spark, tmp_dir, dt.datetime(2100, 1, 1)) == []


@pytest.mark.parametrize("at", ["_write_detailed", "_write_summaries", "commit"])
def test_a_killed_attempt_is_never_seen(spark, tmp_dir, monkeypatch, at):
    go(spark, tmp_dir, BAD)
    where = commits if at == "commit" else runner
    whole = getattr(where, at)

    def dies(*args, **kwargs):
        if at != "commit":
            whole(*args, **kwargs)
        raise RuntimeError("killed")
    monkeypatch.setattr(where, at, dies)
    with pytest.raises(RuntimeError):
        go(spark, tmp_dir, {"good": [(5, None)], "other": [(6, -1.0)]}, LATER)
    assert seen(spark, tmp_dir) == FOUND
    assert {r.Failure_Count for r in runner.read_result(spark, tmp_dir, "aggregated").collect()} == {1, 2}
    states = {(r.Object_ID, r.Val_Status) for r in runner.read_result(spark, tmp_dir, "execution").where(
        f"Last_Upd_Dt = '{LATER.now}'").collect()}
    assert {(1, "Failure"), (2, "Failure")} <= states
    monkeypatch.undo()
    assert commits.vacuum(spark, tmp_dir, dt.datetime(2000, 1, 1)) == []  # nothing is that old
    commits.vacuum(spark, tmp_dir, dt.datetime(2100, 1, 1))
    assert seen(spark, tmp_dir) == FOUND
    go(spark, tmp_dir, {"good": [(5, None)], "other": [(6, 1.0)]}, LATER)
    assert seen(spark, tmp_dir) == [(1, 11, "5")]


def test_one_object_rerun_leaves_the_others(spark, tmp_dir):
    go(spark, tmp_dir, BAD)
    go(spark, tmp_dir, {"other": [(8, -8.0)]}, LATER, objects=[2])
    assert seen(spark, tmp_dir) == FOUND[:4] + [(2, 21, "8")]


def test_commits_of_one_day_are_ordered_by_sequence_not_clock(spark, tmp_dir):
    for attempt, clock in (("b", LATER), ("a", NOON)):   # a clock that goes back
        commits.commit(spark, tmp_dir, [(1, 1, attempt)], clock)
    assert [r.Attempt for r in commits.committed(spark, tmp_dir).collect()] == ["a"]


def test_tables_never_written_read_as_empty(spark, tmp_dir):
    go(spark, tmp_dir, {"good": [(1, 1.0)], "other": []})
    assert runner.read_result(spark, tmp_dir, "schema_findings").collect() == []
    assert seen(spark, tmp_dir) == []


def test_checks_run_once_and_are_counted_by_the_write(spark, tmp_dir, monkeypatch):
    """No read-back of the detailed table, and a Python check is evaluated once per row."""
    calls = spark.sparkContext.accumulator(0)

    def judged(df):
        from pyspark.sql import functions as F

        @F.udf("boolean")
        def odd(v):
            calls.add(1)
            return v % 2 == 1
        return df.where(odd("id"))
    sqlrules.register_python_check("odd_ids", judged)
    cat = Catalog.from_rows(spark, rule=[(1, "odd", '{"custom_python": "odd_ids"}', "Custodial")],
                            object_lookup=[(1, "t", "db", None, "id", "full table", None, None, 1)],
                            rule_mapping=[(1, 1, 1, "id", None, None, "Custodial", 1)], rule_threshold=[(1, 1, 0.0, 1, 1)])
    read = runner._read_back
    monkeypatch.setattr(runner, "_read_back", lambda s, path, schema: pytest.fail(path) if "detailed" in path else read(s, path, schema))
    runner.run(spark, cat, lambda p: spark.range(100).selectExpr("CAST(id AS INT) id"), tmp_dir, clock=NOON)
    assert calls.value == 100
    assert [(r.Failure_Count, r.Failure_Percent) for r in runner.read_result(spark, tmp_dir, "aggregated").collect()] == [(50, 0.5)]


def test_counting_is_exact_and_notices_too_many_items(spark, tmp_dir):
    from pyspark.sql import functions as F
    rows = spark.range(5000).selectExpr("CAST(id % 37 AS INT) k", "id")
    for items, path in ((37, "a"), (100, "b")):
        counting = Counting(F.col("k"), items)
        write_results(rows, f"{tmp_dir}/{path}", partition_by=(), counting=counting)
        assert counting.counts() == {k: len(range(k, 5000, 37)) for k in range(37)}
    counting = Counting(F.col("id"), 10)
    write_results(rows, f"{tmp_dir}/c", partition_by=(), counting=counting)
    with pytest.raises(ValueError):
        counting.counts()
    counting = Counting(F.col("k"), 0)
    write_results(rows.where("false"), f"{tmp_dir}/d", partition_by=(), counting=counting)
    assert counting.counts() == {}


# ---- the file path ---------------------------------------------------------------------

def test_one_broken_object_does_not_end_the_stream(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    for name in ("good", "keyless", "unruled"):
        with open(f"{landing}/{name}.csv", "w") as f:
            f.write("1,\n2,-1.0\n2,3.0\n")
    cat = catalog(spark)
    plans = group_plan(rule_plan(cat).collect())

    def stream():
        query = arrivals.start(spark, landing, "csv", spark.createDataFrame([], "id int, v double").schema, plans, cat.object_lookup,
                               f"{tmp_dir}/out", f"{tmp_dir}/ckpt", clock_fn=lambda: NOON, thresholds=cat.rule_threshold, catalog=cat)
        assert query.awaitTermination(120) and query.exception() is None

    stream()
    read = lambda name: spark.read.parquet(f"{tmp_dir}/out/{name}").collect()
    assert sorted((r.Object_ID, r.Mapping_ID, r.Primary_Key_Value_s_) for r in read("detailed")) == FOUND[:4]
    assert {r.Mapping_ID: (r.Failure_Count, r.Criticality) for r in read("aggregated")} == {11: (1, 1), 12: (2, 1), 13: (1, 1)}
    states = {(r.Object_ID, r.Val_Status) for r in read("execution")}
    assert states == {(i, s) for i, end in ((1, "Success"), (3, "Failure"), (4, "Failure")) for s in ("Executing", end)}
    errors = {(r.Object_ID, r.Test_Key): r.Error for r in read("rule_errors")}
    assert set(errors) == {(3, "object"), (4, "no such key")} and "no_such_key" in errors[3, "object"]
    # The stream goes on with the next files.
    with open(f"{landing}/other.csv", "w") as f:
        f.write("5,-2.0\n")
    stream()
    assert (2, 21, "5") in {(r.Object_ID, r.Mapping_ID, r.Primary_Key_Value_s_) for r in read("detailed")}


def test_a_check_that_fails_when_it_runs_is_isolated_among_files(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    for name in ("a", "b"):
        with open(f"{landing}/{name}.csv", "w") as f:
            f.write("1,12\n2,abc\n")
    cat = Catalog.from_rows(
        spark, rule=[(1, "cast", '{"custom_sql": "SELECT * FROM dfSQL WHERE CAST(v AS INT) > 5"}', "Custodial"),
                     (2, "short", '{"max_length": 2}', "Custodial")],
        object_lookup=[(i, n, "db", "csv", "id", "full table", None, None, 1) for i, n in ((1, "a"), (2, "b"))],
        rule_mapping=[(11, 1, 1, "v", None, None, "Custodial", 1), (12, 1, 2, "v", None, None, "Custodial", 1),
                      (22, 2, 2, "v", None, None, "Custodial", 1)],
        rule_threshold=[(i, m, 0.0, 1, 1) for i, m in enumerate((11, 12, 22))])
    arrivals.start(spark, landing, "csv", spark.createDataFrame([], "id int, v string").schema, group_plan(rule_plan(cat).collect()),
                   cat.object_lookup, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", clock_fn=lambda: NOON).awaitTermination(120)
    read = lambda name: spark.read.parquet(f"{tmp_dir}/out/{name}").collect()
    assert sorted((r.Mapping_ID, r.Actual_Value) for r in read("detailed")) == [(12, "abc"), (22, "abc")]
    assert {r.Mapping_ID for r in read("rule_errors")} == {11}
    assert {(r.Object_ID, r.Val_Status) for r in read("execution")} == {(i, s) for i in (1, 2) for s in ("Executing", "Success")}
