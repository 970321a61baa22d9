"""Rule plan (J1, J2, A12, W5) and the window state machine."""

import datetime as dt

import pytest

from tessera import schemas
from tessera.clock import RunClock
from tessera.plans import windows as W
from tessera.plans.catalog import check_database, group_plan, rule_plan
from tests.catalog_fixture import seed_catalog

NOW = dt.datetime(2024, 6, 1, 12, 0)
CLOCK = RunClock(NOW)


def test_plan_keeps_active_mappings_with_thresholds(spark):
    rows = rule_plan(seed_catalog(spark)).collect()
    ids = sorted(r["Mapping_ID"] for r in rows)
    # 12 has no threshold, 25 is inactive, 30 belongs to an inactive object
    assert ids == [2, 3, 5, 6, 8, 10, 13, 17, 18, 20]


def test_plan_without_threshold_requirement(spark):
    ids = sorted(r["Mapping_ID"] for r in rule_plan(seed_catalog(spark), require_threshold=False).collect())
    assert 12 in ids and 25 not in ids and 30 not in ids


def test_plan_for_a_file_object_by_database_and_name(spark):
    rows = rule_plan(seed_catalog(spark), database="library", object_name="returns").collect()
    assert sorted(r["Mapping_ID"] for r in rows) == [17, 18]


def test_group_plan_and_database_gate(spark):
    rows = rule_plan(seed_catalog(spark), object_ids=[1, 2]).collect()
    plans = group_plan(rows)
    assert [p.object_id for p in plans] == [1, 2]
    assert plans[1].date_col == "lent_on" and plans[0].primary_key == "member_no"
    check_database(rows, "library")
    with pytest.raises(ValueError):
        check_database(rule_plan(seed_catalog(spark), object_ids=[7]).collect(), "library")


def _objects(spark):
    return spark.createDataFrame([
        (1, "a", "d", None, "id", "full table", None, "f", 1),
        (2, "b", "d", None, "id", "daily", None, "f", 1),
        (3, "c", "d", None, "id", "full table", None, "f", 1),
        (4, "e", "d", None, "id", "daily", 60, "f", 1),
        (5, "g", "d", None, "id", "daily", None, "f", 1),
        (6, "h", "d", None, "id", "monthly", None, "f", 1),
    ], schemas.OBJECT_LOOKUP)


def _history(spark):
    t = lambda *a: dt.datetime(*a)
    rows = [
        # object 3: last Success, full table
        (3, "full table", "f", "Automatic", None, None, t(1900, 1, 1), t(2024, 5, 31), t(1900, 1, 1), t(2024, 6, 1),
         "Success", t(2024, 5, 31, 6), 1, "j"),
        # object 4: older Executing, then Success with 60-minute windows
        (4, "daily", "f", "Automatic", None, None, t(2024, 6, 1, 9), t(2024, 6, 1, 10), t(2024, 6, 1, 10),
         t(2024, 6, 1, 11), "Executing", t(2024, 6, 1, 10), 4, "j"),
        (4, "daily", "f", "Automatic", None, None, t(2024, 6, 1, 9), t(2024, 6, 1, 10), t(2024, 6, 1, 10),
         t(2024, 6, 1, 11), "Success", t(2024, 6, 1, 10, 5), 4, "j"),
        # object 5: still Executing
        (5, "daily", "f", "Automatic", None, None, t(2024, 5, 31), t(2024, 6, 1), t(2024, 6, 1), t(2024, 6, 2),
         "Executing", t(2024, 6, 1, 11), 7, "j"),
        # object 6: Failure
        (6, "monthly", "f", "Automatic", t(2024, 3, 1), t(2024, 4, 1), t(2024, 4, 1), t(2024, 5, 1), t(2024, 5, 1),
         t(2024, 6, 1), "Failure", t(2024, 5, 2), 2, "j"),
    ]
    return spark.createDataFrame(rows, schemas.EXECUTION)


def test_window_state_machine(spark):
    objects = _objects(spark)
    run_ids = objects.select("Object_ID").selectExpr("Object_ID", "CAST(9 AS INT) AS Run_Id")
    got = {r["Object_ID"]: r for r in W.next_windows(objects, _history(spark), CLOCK, run_ids, "job").collect()}
    day = dt.timedelta(days=1)
    # W1a first run, full table
    assert (got[1]["Val_St_Dt"], got[1]["Val_End_Dt"], got[1]["Next_Val_End_Dt"]) == (
        dt.datetime(1900, 1, 1), NOW, NOW + day)
    assert got[1]["Prev_Val_St_Dt"] is None and got[1]["Action"] == "new"
    # W1b first run, delta of one day
    assert (got[2]["Val_St_Dt"], got[2]["Val_End_Dt"]) == (NOW - day, NOW)
    assert (got[2]["Next_Val_St_Dt"], got[2]["Next_Val_End_Dt"]) == (NOW, NOW + day)
    # W1c success, full table: previous = last current
    assert got[3]["Prev_Val_End_Dt"] == dt.datetime(2024, 5, 31) and got[3]["Val_End_Dt"] == NOW
    # W1d success, delta with a 60-minute interval: current = last next
    assert (got[4]["Val_St_Dt"], got[4]["Val_End_Dt"]) == (dt.datetime(2024, 6, 1, 10), dt.datetime(2024, 6, 1, 11))
    assert got[4]["Next_Val_End_Dt"] == dt.datetime(2024, 6, 1, 12) and got[4]["Run_Id"] == 9
    # W1e executing: reuse window and run id, no new row
    assert (got[5]["Val_St_Dt"], got[5]["Run_Id"], got[5]["Action"], got[5]["Append"]) == (
        dt.datetime(2024, 5, 31), 7, "reuse", False)
    # W1f failure: same window, retried with a new row
    assert (got[6]["Val_St_Dt"], got[6]["Val_End_Dt"], got[6]["Action"], got[6]["Append"]) == (
        dt.datetime(2024, 4, 1), dt.datetime(2024, 5, 1), "retry", True)
    rows = W.execution_rows(W.next_windows(objects, _history(spark), CLOCK, run_ids, "job"), CLOCK)
    assert sorted(r["Object_ID"] for r in rows.collect()) == [1, 2, 3, 4, 6]


def test_durations_by_period_and_interval(spark):
    df = spark.createDataFrame([("daily", None), ("monthly", None), ("yearly", None), ("daily", 60),
                                ("full table", None), ("weird", None)], "p string, i int")
    got = [r[0] for r in df.select(W.duration_minutes(df["i"], df["p"])).collect()]
    assert got == [1440, 43830, 525960, 60, None, None]


def test_next_run_ids(spark):
    log = spark.createDataFrame([(3, 1, dt.datetime(2024, 6, 1, 1)), (5, 1, dt.datetime(2024, 6, 1, 2)),
                                 (9, 2, dt.datetime(2024, 5, 31, 1))],
                                "Object_Log_ID int, Object_ID int, Last_Update_Date timestamp")
    objects = spark.createDataFrame([(1,), (2,), (3,)], "Object_ID int")
    got = {r["Object_ID"]: r["Run_Id"] for r in W.next_run_ids(log, objects, CLOCK).collect()}
    assert got == {1: 6, 2: 1, 3: 1}


def test_status_transition_appends_rows(spark):
    hist = _history(spark)
    outcomes = spark.createDataFrame([(5, 7, "Success")], "Object_ID int, Run_Id int, Val_Status string")
    rows = W.status_rows(hist, outcomes, CLOCK).collect()
    assert len(rows) == 1 and rows[0]["Val_Status"] == "Success" and rows[0]["Last_Upd_Dt"] == NOW
    latest = W.latest_state(hist.unionByName(W.status_rows(hist, outcomes, CLOCK)))
    assert {r["Object_ID"]: r["last_Val_Status"] for r in latest.collect()}[5] == "Success"
