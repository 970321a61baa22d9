"""Incremental validation windows and run state.

The execution-status table is append-only: every state change is a new row and
readers take each object's latest row (A9). One DataFrame job computes the
next window of every object at once (W1); no query per object.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.clock import RunClock
from tessera.functions.projection import ts_lit

# Minutes per validation period. 'full table' has no length: it is its own branch.
PERIOD_MINUTES = {"daily": 1440, "monthly": 43830, "yearly": 525960}
FULL_TABLE = "full table"
EPOCH_START = dt.datetime(1900, 1, 1)

STATE_COLUMNS = ["Prev_Val_St_Dt", "Prev_Val_End_Dt", "Curr_Val_St_Dt", "Curr_Val_End_Dt",
                 "Next_Val_St_Dt", "Next_Val_End_Dt", "Val_Status", "Run_Id", "Last_Upd_Dt"]


def duration_minutes(time_interval: Column, period: Column) -> Column:
    """Time_Interval if set, else by period (null-safe)."""
    by_period = F.lit(None).cast("int")
    for name, minutes in PERIOD_MINUTES.items():
        by_period = F.when(F.lower(period) == name, F.lit(minutes)).otherwise(by_period)
    return F.coalesce(time_interval.cast("int"), by_period)


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


def latest_state(execution: DataFrame) -> DataFrame:
    """Each object's most recent execution row.

    A run stamps its 'Executing' row and its closing 'Success'/'Failure' row with
    the same clock, so on equal times the closing state wins.
    """
    closing = F.when(F.col("Val_Status") == "Executing", F.lit(0)).otherwise(F.lit(1))
    return (execution.groupBy("Object_ID")
            .agg(F.max_by(F.struct(*STATE_COLUMNS), F.struct(F.col("Last_Upd_Dt"), closing)).alias("_s"))
            .select("Object_ID", *[F.col(f"_s.{c}").alias(f"last_{c}") for c in STATE_COLUMNS]))


def next_run_ids(object_log: DataFrame | None, objects: DataFrame, clock: RunClock) -> DataFrame:
    """Per object, 1 + the highest run id logged on the clock's day, else 1."""
    base = objects.select("Object_ID").distinct()
    if object_log is None:
        return base.withColumn("Run_Id", F.lit(1))
    today = (object_log.where(F.to_date("Last_Update_Date") == F.lit(clock.period.isoformat()).cast("date"))
             .groupBy("Object_ID").agg(F.max("Object_Log_ID").alias("_max")))
    return (base.join(today, "Object_ID", "left")
            .select("Object_ID", F.coalesce(F.col("_max") + 1, F.lit(1)).cast("int").alias("Run_Id")))


def next_windows(objects: DataFrame, execution: DataFrame | None, clock: RunClock,
                 run_ids: DataFrame, job_id: str = "") -> DataFrame:
    """W1a-W1f for every object in one plan.

    Output: Object_ID, Val_St_Dt, Val_End_Dt, Run_Id, Action ('new', 'reuse', 'retry')
    and the execution row to append (Append = true for new and retry).
    """
    now, day = ts_lit(clock.now), F.lit(1440)
    obj = objects.select("Object_ID", "Validation_Period", "Time_Interval", "Validation_Frequency")
    if execution is not None:
        obj = obj.join(latest_state(execution), "Object_ID", "left")
    else:
        for c in STATE_COLUMNS:
            obj = obj.withColumn(f"last_{c}", F.lit(None).cast("string" if c == "Val_Status" else
                                                                 "int" if c == "Run_Id" else "timestamp"))
    obj = obj.join(run_ids, "Object_ID", "left")
    d = duration_minutes(F.col("Time_Interval"), F.col("Validation_Period"))
    full = F.lower(F.col("Validation_Period")) == FULL_TABLE
    status = F.col("last_Val_Status")
    first, success = status.isNull(), status == "Success"
    executing, failure = status == "Executing", status == "Failure"
    epoch = ts_lit(EPOCH_START)
    L = lambda c: F.col(f"last_{c}")

    def pick(first_full, first_delta, success_full, success_delta, executing_v, failure_v):
        return (F.when(first & full, first_full).when(first, first_delta)
                .when(success & full, success_full).when(success, success_delta)
                .when(executing, executing_v).when(failure, failure_v))

    out = obj.select(
        "Object_ID", "Validation_Period", "Validation_Frequency",
        pick(F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp"), L("Curr_Val_St_Dt"),
             _plus_minutes(L("Next_Val_St_Dt"), -d), L("Prev_Val_St_Dt"), L("Prev_Val_St_Dt")).alias("Prev_Val_St_Dt"),
        pick(F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp"), L("Curr_Val_End_Dt"),
             _plus_minutes(L("Next_Val_End_Dt"), -d), L("Prev_Val_End_Dt"), L("Prev_Val_End_Dt")).alias("Prev_Val_End_Dt"),
        pick(epoch, _plus_minutes(now, -d), epoch, L("Next_Val_St_Dt"), L("Curr_Val_St_Dt"),
             L("Curr_Val_St_Dt")).alias("Curr_Val_St_Dt"),
        pick(now, now, now, L("Next_Val_End_Dt"), L("Curr_Val_End_Dt"), L("Curr_Val_End_Dt")).alias("Curr_Val_End_Dt"),
        pick(epoch, now, epoch, _plus_minutes(L("Next_Val_St_Dt"), d), L("Next_Val_St_Dt"),
             L("Next_Val_St_Dt")).alias("Next_Val_St_Dt"),
        pick(_plus_minutes(now, day), _plus_minutes(now, d), _plus_minutes(now, day),
             _plus_minutes(L("Next_Val_End_Dt"), d), L("Next_Val_End_Dt"), L("Next_Val_End_Dt")).alias("Next_Val_End_Dt"),
        F.when(executing, L("Run_Id")).otherwise(F.col("Run_Id")).cast("int").alias("Run_Id"),
        F.when(executing, "reuse").when(failure, "retry").otherwise("new").alias("Action"),
        (full | d.isNotNull()).alias("_known_period"),
    )
    return (out.withColumn("Val_St_Dt", F.col("Curr_Val_St_Dt"))
            .withColumn("Val_End_Dt", F.col("Curr_Val_End_Dt"))
            .withColumn("Append", F.col("Action") != "reuse")
            .withColumn("Job_Id", F.lit(job_id)))


def execution_rows(windows: DataFrame, clock: RunClock) -> DataFrame:
    """New 'Executing' rows for objects that start (or retry) a window."""
    return windows.where("Append").select(
        F.col("Object_ID").cast("int"), "Validation_Period", "Validation_Frequency",
        F.lit("Automatic").alias("Run_Type"), "Prev_Val_St_Dt", "Prev_Val_End_Dt", "Curr_Val_St_Dt",
        "Curr_Val_End_Dt", "Next_Val_St_Dt", "Next_Val_End_Dt", F.lit("Executing").alias("Val_Status"),
        ts_lit(clock.now).alias("Last_Upd_Dt"), F.col("Run_Id").cast("int"), F.col("Job_Id"))


def status_rows(execution: DataFrame, outcomes: DataFrame, clock: RunClock) -> DataFrame:
    """Executing -> Success/Failure as new rows. ``outcomes``: (Object_ID, Run_Id, Val_Status)."""
    latest = (execution.where(F.col("Val_Status") == "Executing")
              .join(outcomes.select("Object_ID", "Run_Id"), ["Object_ID", "Run_Id"], "left_semi")
              .groupBy("Object_ID", "Run_Id")
              .agg(F.max_by(F.struct(*[c for c in execution.columns if c not in ("Object_ID", "Run_Id")]),
                            F.col("Last_Upd_Dt")).alias("_s")))
    cols = [c for c in execution.columns]
    joined = latest.join(outcomes.withColumnRenamed("Val_Status", "_new"), ["Object_ID", "Run_Id"])
    return joined.select(*[
        F.col("_new").alias(c) if c == "Val_Status" else ts_lit(clock.now).alias(c) if c == "Last_Upd_Dt"
        else F.col(c) if c in ("Object_ID", "Run_Id") else F.col(f"_s.{c}").alias(c) for c in cols])
