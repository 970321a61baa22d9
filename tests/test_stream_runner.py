"""File-arrival stream (S13) and the end-to-end catalog run."""

import datetime as dt
import os
from decimal import Decimal

from pyspark.sql import functions as F

from tessera import schemas
from tessera.clock import RunClock
from tessera.plans.catalog import Catalog, group_plan, rule_plan
from tessera.plans.engine import ObjectRun, validate
from tessera.plans.runner import run
from tessera.streaming import arrivals
from tests.conftest import SF001

ACCOUNT_SCHEMA = "Id int, Name string, Balance double"


def _catalog(spark):
    rules = [(1, "not null", '{"is_nullable": "NO"}', "Custodial"), (2, "unique", '{"distinct": true}', "Custodial"),
             (3, "balance >= 0", '{"min": 0}', "Custodial"),
             (4, "segment", '{"allowed": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]}', "Custodial"),
             (5, "orders without lines",
              "SELECT o_orderkey, o_custkey FROM `p.tpch.orders` WHERE NOT EXISTS "
              "(SELECT 1 FROM `p.tpch.lineitem` WHERE l_orderkey = o_orderkey);", "Business"),
             (6, "events are not errors", '{"forbidden": ["error"]}', "Custodial")]
    objects = [(1, "customer", "tpch", None, "c_custkey", "full table", None, "daily", 1),
               (2, "orders", "tpch", None, "o_orderkey", "full table", None, "daily", 1),
               (3, "events", "tpch", None, "event_id", "daily", 60, "hourly", 1),
               (4, "account", "files", "csv", "Id", "full table", None, "On file upload", 1)]
    mappings = [(1, 1, 1, "c_custkey", None, None, "Custodial", 1), (2, 1, 3, "c_acctbal", None, None, "Custodial", 1),
                (3, 1, 4, "c_mktsegment", None, None, "Custodial", 1), (4, 2, 2, "o_custkey", None, None, "Custodial", 1),
                (5, 2, 5, "o_orderkey, o_custkey", "tpch.orders,tpch.lineitem", None, "Business", 1),
                (6, 3, 6, "event_type", None, "ts", "Custodial", 1), (7, 3, 2, "event_id", None, "ts", "Custodial", 1),
                (8, 4, 1, "Id", None, None, "Custodial", 1), (9, 4, 2, "Id", None, None, "Custodial", 1),
                (10, 4, 3, "Balance", None, None, "Custodial", 1)]
    thresholds = [(i, m, Decimal(v), c, 1) for i, (m, v, c) in enumerate(
        [(1, "0", 3), (2, "0.01", 1), (2, "0.05", 2), (3, "0.1", 2), (4, "0", 3), (5, "0", 2), (6, "0.1", 1),
         (7, "0", 3), (8, "0", 3), (9, "0", 3), (10, "0", 2)], 1)]
    routes = dict(handler=[(1, "LOW"), (2, "MEDIUM"), (3, "HIGH")], distribution=[(1, "team@example.com")],
                  notification=[(1, 1, 1), (2, 1, 2), (3, 1, 3)],
                  object_notification=[(1, 1, 1, 1), (2, 1, 2, 2), (3, 2, 3, 3), (4, 3, 1, 1)])
    return Catalog.from_rows(spark, rule=rules, object_lookup=objects, rule_mapping=mappings,
                             rule_threshold=thresholds, **routes)


def test_catalog_run_end_to_end(spark, tmp_dir):
    cat = _catalog(spark)
    tables = {t: spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("customer", "orders", "events", "lineitem")}
    clock = RunClock(dt.datetime(2024, 1, 15, 12, 0))
    report = run(spark, cat, lambda p: tables[p.object_name], tmp_dir, clock=clock, job_id="t",
                 tables={"tpch.orders": tables["orders"], "tpch.lineitem": tables["lineitem"]}, object_ids=[1, 2, 3])
    assert report.objects == [1, 2, 3] and not report.failed_objects
    agg = {r["Mapping_ID"]: r for r in spark.read.parquet(f"{tmp_dir}/aggregated").collect()}
    assert sorted(agg) == [1, 2, 3, 4, 5, 6, 7]
    cust = tables["customer"]
    assert agg[2]["Failure_Count"] == cust.where("c_acctbal < 0").count()
    assert agg[3]["Failure_Count"] == cust.where("c_mktsegment = 'MACHINERY'").count()
    # events: one hour window [11:00, 12:00) on the clock's day
    hour = tables["events"].where((F.col("ts") >= "2024-01-15 11:00:00") & (F.col("ts") < "2024-01-15 12:00:00"))
    assert agg[6]["Failure_Count"] == hour.where("event_type = 'error'").count()
    detailed = spark.read.parquet(f"{tmp_dir}/detailed")
    per_mapping = {r["Mapping_ID"]: r["count"] for r in detailed.groupBy("Mapping_ID").count().collect()}
    assert all(per_mapping.get(m, 0) == a["Failure_Count"] for m, a in agg.items())
    log = spark.read.parquet(f"{tmp_dir}/object_log").collect()
    assert sorted(r["Object_ID"] for r in log) == [1, 2, 3]
    execution = spark.read.parquet(f"{tmp_dir}/execution")
    states = sorted((r["Object_ID"], r["Val_Status"]) for r in execution.collect())
    assert states == [(1, "Executing"), (1, "Success"), (2, "Executing"), (2, "Success"),
                      (3, "Executing"), (3, "Success")]
    alerts = spark.read.parquet(f"{tmp_dir}/alerts")
    assert alerts.where("Object_ID = 1 AND Criticality = 2").first()["Notification_Handler_Text"] == "MEDIUM"


def test_stream_of_files_equals_batch_per_file(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    files = {"account.csv": "1,Ann,5.0\n2,Bo,-1.0\n2,Bo2,3.0\n", "account_2.csv": "7,Cy,1.0\n",
             "other.csv": "1,x,-5\n"}
    for name, body in files.items():
        with open(os.path.join(landing, name), "w") as f:
            f.write(body)
    cat = _catalog(spark)
    plan = group_plan(rule_plan(cat, object_ids=[4]).collect())[0]
    clock = RunClock(dt.datetime(2024, 6, 1))
    q = arrivals.start(spark, landing, "csv", spark.createDataFrame([], ACCOUNT_SCHEMA).schema, plan,
                       cat.object_lookup, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", clock_fn=lambda: clock,
                       thresholds=cat.rule_threshold, catalog=cat)
    q.awaitTermination(120)
    streamed = spark.read.parquet(f"{tmp_dir}/out/detailed").collect()
    got = sorted((r["Mapping_ID"], r["Primary_Key_Value_s_"]) for r in streamed)
    # only account.csv matches the registered table id; account_2 and other are not 'account'
    batch_df = spark.read.schema(ACCOUNT_SCHEMA).csv(os.path.join(landing, "account.csv"))
    batch = validate(spark, ObjectRun(4, "account", "Id", batch_df, plan.mappings, clock))
    expected = sorted((r["Mapping_ID"], r["Primary_Key_Value_s_"]) for r in batch.detailed.collect())
    assert got == expected == [(9, "2"), (9, "2"), (10, "2")]
    # alerts on the file path: mappings 9 and 10 fail, object 4 has no route -> handler text NULL
    alert_rows = spark.read.parquet(f"{tmp_dir}/out/alerts").collect()
    assert sorted(r["Rule_ID"] for r in alert_rows) == [2, 3]
    assert all(r["Notification_Handler_Text"] is None for r in alert_rows)


def test_files_of_a_batch_are_told_apart(spark, tmp_dir):
    """Two files of one object in one micro-batch: results, counts, run ids and states per file; jobs do not grow with files."""
    folders = [os.path.join(tmp_dir, d) for d in ("landing/a", "landing/b", "more/c")]
    for folder in folders:
        os.makedirs(folder)
    bodies = ["1,Ann,5.0\n2,Bo,-1.0\n2,Bo2,3.0\n", "2,Cy,1.0\n3,Di,-4.0\n", "9,Ed,-2.0\n"]
    for folder, body in zip(folders, bodies):
        with open(os.path.join(folder, "account.csv"), "w") as f:
            f.write(body)
    cat = _catalog(spark)
    plans = group_plan(rule_plan(cat, object_ids=[4]).collect())
    schema = spark.createDataFrame([], ACCOUNT_SCHEMA).schema

    def stream(landing, hour):
        arrivals.start(spark, landing, "csv", schema, plans, cat.object_lookup, f"{tmp_dir}/out", f"{tmp_dir}/ckpt-{hour}",
                       clock_fn=lambda: RunClock(dt.datetime(2024, 6, 1, hour)), thresholds=cat.rule_threshold, catalog=cat,
                       options={"recursiveFileLookup": "true"}).awaitTermination(120)

    stream(f"{tmp_dir}/landing", 8)
    of = lambda p: p.split("/")[-2]
    rows = spark.read.parquet(f"{tmp_dir}/out/detailed").collect()
    assert sorted((of(r.Source_File), r.Run_ID, r.Mapping_ID, r.Primary_Key_Value_s_) for r in rows) == [
        ("a", 1, 9, "2"), ("a", 1, 9, "2"), ("a", 1, 10, "2"), ("b", 2, 10, "3")]
    agg = {(of(r.Source_File), r.Mapping_ID): (r.Run_ID, r.Failure_Count, round(r.Failure_Percent, 4))
           for r in spark.read.parquet(f"{tmp_dir}/out/aggregated").collect()}
    assert agg == {("a", 8): (1, 0, 0.0), ("a", 9): (1, 2, round(2 / 3, 4)), ("a", 10): (1, 1, round(1 / 3, 4)),
                   ("b", 8): (2, 0, 0.0), ("b", 9): (2, 0, 0.0), ("b", 10): (2, 1, 0.5)}
    states = {(of(r.Source_File), r.Run_Id, r.Val_Status) for r in spark.read.parquet(f"{tmp_dir}/out/execution").collect()}
    assert states == {(f, i, s) for f, i in (("a", 1), ("b", 2)) for s in ("Executing", "Success")}
    # The day's run ids go on from what was logged.
    last = arrivals.last_run_ids(spark, f"{tmp_dir}/out", 5, RunClock(dt.datetime(2024, 6, 1, 9)))
    assert last == {4: 2} and arrivals.last_run_ids(spark, f"{tmp_dir}/out", 5, RunClock(dt.datetime(2024, 6, 2))) == {}


def test_declared_schema_frame(spark):
    df = spark.createDataFrame([("o_orderkey", "INT64", "NO")], schemas.DECLARED_SCHEMA)
    from tessera.operators.schema_check import declared_list
    assert declared_list(df) == [("o_orderkey", "INT64", "NO")]


def test_unknown_period_or_missing_date_column_fails_the_object(spark, tmp_dir):
    bad = Catalog.from_rows(
        spark, rule=[(1, "not null", '{"is_nullable": "NO"}', "Custodial")],
        object_lookup=[(1, "customer", "tpch", None, "c_custkey", "fortnightly", None, None, 1),
                       (2, "orders", "tpch", None, "o_orderkey", "daily", None, None, 1)],
        rule_mapping=[(1, 1, 1, "c_custkey", None, "c_custkey", "Custodial", 1),
                      (2, 2, 1, "o_orderkey", None, None, "Custodial", 1)],
        rule_threshold=[(1, 1, Decimal("0"), 3, 1), (2, 2, Decimal("0"), 3, 1)],
        handler=[], distribution=[], notification=[], object_notification=[])
    tables = {t: spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("customer", "orders")}
    report = run(spark, bad, lambda p: tables[p.object_name], tmp_dir, clock=RunClock(dt.datetime(2024, 1, 15)))
    assert sorted(report.failed_objects) == [1, 2]
    states = sorted((r["Object_ID"], r["Val_Status"]) for r in spark.read.parquet(f"{tmp_dir}/execution").collect())
    assert (1, "Failure") in states and (2, "Failure") in states


def test_rerun_of_the_same_object_run_does_not_duplicate(spark, tmp_dir):
    cat = _catalog(spark)
    tables = {t: spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("customer", "orders", "events", "lineitem")}
    clock = RunClock(dt.datetime(2024, 1, 15, 12, 0))
    for _ in range(2):  # no object log given: both runs get run id 1 for the same day
        run(spark, cat, lambda p: tables[p.object_name], tmp_dir, clock=clock, object_ids=[1])
    detailed = spark.read.parquet(f"{tmp_dir}/detailed")
    cust = tables["customer"]  # a row failing both rules is reported once per rule
    expected = cust.where("c_acctbal < 0").count() + cust.where("c_mktsegment = 'MACHINERY'").count()
    assert detailed.count() == expected
    assert spark.read.parquet(f"{tmp_dir}/aggregated").count() == 3
    assert spark.read.parquet(f"{tmp_dir}/object_log").count() == 1


def test_second_run_continues_after_the_first_window(spark, tmp_dir):
    cat = Catalog.from_rows(
        spark, rule=[(1, "no errors", '{"forbidden": ["error"]}', "Custodial")],
        object_lookup=[(3, "events", "tpch", None, "event_id", "daily", 60, "hourly", 1)],
        rule_mapping=[(6, 3, 1, "event_type", None, "ts", "Custodial", 1)],
        rule_threshold=[(1, 6, Decimal("0.1"), 1, 1)],
        handler=[], distribution=[], notification=[], object_notification=[])
    events = spark.read.parquet(f"{SF001}/events.parquet")
    first, second = f"{tmp_dir}/a", f"{tmp_dir}/b"
    run(spark, cat, lambda p: events, first, clock=RunClock(dt.datetime(2024, 1, 15, 12, 0)))
    history = spark.read.parquet(f"{first}/execution")
    log = spark.read.parquet(f"{first}/object_log")
    run(spark, cat, lambda p: events, second, clock=RunClock(dt.datetime(2024, 1, 15, 13, 0)),
        execution=history, object_log=log)
    a = spark.read.parquet(f"{first}/object_log").first()
    b = spark.read.parquet(f"{second}/object_log").first()
    # the second run validates the next hour and takes the next run id
    assert (a["val_st_dt"], a["val_end_dt"]) == (dt.datetime(2024, 1, 15, 11), dt.datetime(2024, 1, 15, 12))
    assert (b["val_st_dt"], b["val_end_dt"]) == (dt.datetime(2024, 1, 15, 12), dt.datetime(2024, 1, 15, 13))
    assert (a["Object_Log_ID"], b["Object_Log_ID"]) == (1, 2)


def test_resumed_window_keeps_run_id_and_closes_it(spark, tmp_dir):
    from tessera.plans import windows as W
    cat = Catalog.from_rows(
        spark, rule=[(1, "no errors", '{"forbidden": ["error"]}', "Custodial")],
        object_lookup=[(3, "events", "tpch", None, "event_id", "daily", 60, "hourly", 1)],
        rule_mapping=[(6, 3, 1, "event_type", None, "ts", "Custodial", 1)],
        rule_threshold=[(1, 6, Decimal("0.1"), 1, 1)],
        handler=[], distribution=[], notification=[], object_notification=[])
    events = spark.read.parquet(f"{SF001}/events.parquet")
    crashed = RunClock(dt.datetime(2024, 1, 15, 12, 0))  # an attempt that wrote 'Executing' and died
    objects = cat.object_lookup
    started = W.execution_rows(W.next_windows(objects, None, crashed, W.next_run_ids(None, objects, crashed)), crashed)
    run(spark, cat, lambda p: events, tmp_dir, clock=RunClock(dt.datetime(2024, 1, 15, 12, 30)), execution=started)
    log = spark.read.parquet(f"{tmp_dir}/object_log").first()
    assert (log["val_st_dt"], log["val_end_dt"]) == (dt.datetime(2024, 1, 15, 11), dt.datetime(2024, 1, 15, 12))
    states = [(r["Run_Id"], r["Val_Status"]) for r in spark.read.parquet(f"{tmp_dir}/execution").collect()]
    assert states == [(1, "Success")]  # no second 'Executing' row; the resumed run is closed


def test_current_results_drop_an_earlier_attempts_rows(spark, tmp_dir):
    from tessera.plans.runner import current_results
    cat = _catalog(spark)
    customer = spark.read.parquet(f"{SF001}/customer.parquet")
    run(spark, cat, lambda p: customer, tmp_dir, clock=RunClock(dt.datetime(2024, 1, 15, 12, 0)), object_ids=[1])
    assert current_results(spark, tmp_dir).count() > 0
    # same day, same run id, and this time nothing fails: the old partition is not rewritten
    run(spark, cat, lambda p: customer.where("1 = 0"), tmp_dir, clock=RunClock(dt.datetime(2024, 1, 15, 13, 0)),
        object_ids=[1])
    assert spark.read.parquet(f"{tmp_dir}/detailed").count() > 0
    assert current_results(spark, tmp_dir).count() == 0
    agg = {r["Mapping_ID"]: r["Failure_Count"] for r in current_results(spark, tmp_dir, "aggregated").collect()}
    assert agg == {1: 0, 2: 0, 3: 0}


def test_rule_failing_at_run_time_is_isolated(spark, tmp_dir):
    """A query that breaks on a row lands in rule_errors; its object's other rules and other objects are written."""
    good = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    bad = spark.createDataFrame([(1, "12"), (2, "abc")], "id int, v string")
    catalog = Catalog.from_rows(
        spark, rule=[(1, "present", '{"is_nullable": "NO"}', "Custodial"),
                     (2, "cast", '{"custom_sql": "SELECT id, v FROM dfSQL WHERE CAST(v AS INT) > 5"}', "Custodial"),
                     (3, "short", '{"max_length": 2}', "Custodial"), (4, "command", "DROP VIEW victim", "Business"),
                     (5, "insert", "INSERT INTO victim VALUES (1)", "Business")],
        object_lookup=[(1, "good", "db", None, "id", "full table", None, None, 1),
                       (2, "bad", "db", None, "id", "full table", None, None, 1)],
        rule_mapping=[(1, 1, 1, "v", None, None, "Custodial", 1), (2, 2, 2, "v", None, None, "Custodial", 1),
                      (3, 2, 3, "v", None, None, "Custodial", 1), (4, 2, 4, "v", None, None, "Business", 1),
                      (5, 2, 5, "v", None, None, "Business", 1)],
        rule_threshold=[(i, i, 0.0, 3, 1) for i in range(1, 6)])
    spark.range(1).createOrReplaceTempView("victim")
    report = run(spark, catalog, lambda p: good if p.object_id == 1 else bad, tmp_dir, clock=RunClock(dt.datetime(2024, 1, 15)))
    assert not report.failed_objects
    assert spark.catalog.tableExists("victim")
    detailed = {(r.Mapping_ID, r.Actual_Value) for r in spark.read.parquet(f"{tmp_dir}/detailed").collect()}
    assert detailed == {(1, None), (3, "abc")}
    errors = {r.Mapping_ID: r.Error for r in spark.read.parquet(f"{tmp_dir}/rule_errors").collect()}
    assert set(errors) == {2, 4, 5} and "single query" in errors[4]
    states = {(r.Object_ID, r.Val_Status) for r in spark.read.parquet(f"{tmp_dir}/execution").collect()}
    assert {(1, "Success"), (2, "Success")} <= states


def test_object_without_any_evaluated_rule_fails(spark, tmp_dir):
    cat = Catalog.from_rows(spark, rule=[(1, "nonsense", '{"no such key": 1}', "Custodial")],
                            object_lookup=[(1, "one", "db", None, "id", "full table", None, None, 1)],
                            rule_mapping=[(1, 1, 1, "v", None, None, "Custodial", 1)], rule_threshold=[(1, 1, 0.0, 3, 1)])
    report = run(spark, cat, lambda p: spark.range(3).selectExpr("id", "id AS v"), tmp_dir, clock=RunClock(dt.datetime(2024, 1, 15)))
    assert list(report.failed_objects) == [1]
    assert spark.read.parquet(f"{tmp_dir}/rule_errors").count() == 1
    assert {r.Val_Status for r in spark.read.parquet(f"{tmp_dir}/execution").collect()} == {"Executing", "Failure"}


def test_run_plan_grows_with_objects_not_their_square(spark):
    """Every source is counted once in the aggregate of all objects."""
    from tessera.operators import summary
    from tessera.plans.engine import mapping_meta
    from tessera.operators.spec import Mapping
    sizes = []
    for n in (2, 8):
        meta = mapping_meta(spark, [(f"o{i}", 1, Mapping(i, 1, i, "v", "{}", "Custodial", "", f"o{i}", "id")) for i in range(n)])
        counts = spark.range(n).selectExpr("CAST(id AS INT) AS Mapping_ID", "1L AS Failure_Count", "2L AS Row_Count")
        frame = summary.aggregated_rows(counts, meta, None, dt.datetime(2024, 1, 15))
        sizes.append(frame._jdf.queryExecution().optimizedPlan().toString().count("Range ("))
        assert frame.count() == n
    assert sizes[0] == sizes[1] == 1
