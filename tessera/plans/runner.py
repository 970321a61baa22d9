"""End-to-end validation run over a catalog (the table path of the reference job).

Steps: rule plan (J1/J2) -> windows and run ids for all objects (W1, A8) ->
'Executing' rows -> validate every object -> write the detailed table once for
all objects, counting failures per mapping in the write -> aggregate from these
counts plus one row count per object -> object log, rule errors, alerts ->
commit of the attempt (see ``commits``) -> 'Success'/'Failure' rows.

A rule can also fail while it runs. If the joint write fails, each object is
written alone; where that fails too, the checks with plans of their own are run
one by one, the broken ones go to ``rule_errors`` and the object is written with
the others. States are closed whatever happens.

The number of Spark jobs depends on the number of objects and result tables,
not on the number of row-local rules. Key, lookup and SQL checks run once, in the
write of their failures: the counts are observed metrics of that write, and
nothing written is read back to be counted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.clock import RunClock
from tessera.functions.local import local_frame
from tessera.functions.projection import date_lit
from tessera.operators import alerts as alert_ops
from tessera.operators import summary
from tessera.operators.schema_check import declared_list, schema_diff
from tessera.plans import commits
from tessera.plans import windows as W
from tessera.plans.catalog import Catalog, ObjectPlan, check_database, group_plan, rule_plan
from tessera.plans.engine import ObjectRun, ValidationResult, broken_checks, mapping_meta, validate
from tessera.sources.readers import register_tables, windowed
from tessera.sources.sinks import MAX_COUNTED, Counting, write_results

# Result tables are partitioned by day, object, run and attempt; readers follow the commit log.
# loader(object plan) -> the object's full DataFrame (the window is applied here)
Loader = Callable[[ObjectPlan], DataFrame]
Evaluated = tuple[ObjectPlan, ObjectRun, ValidationResult]
Runs = list[tuple[int, int, str]]  # (Object_ID, Run_ID, Attempt)


@dataclass
class RunReport:
    out_dir: str
    objects: list[int]
    failed_objects: dict[int, str] = field(default_factory=dict)
    actions: int = 0


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def run(spark: SparkSession, catalog: Catalog, loader: Loader, out_dir: str, clock: RunClock | None = None,
        job_id: str = "", execution: DataFrame | None = None, object_log: DataFrame | None = None,
        tables: dict[str, DataFrame] | None = None, declared: dict[int, object] | None = None,
        object_ids: list[int] | None = None, alert_mode: str = "equal",
        load_table: Callable[[str], DataFrame] | None = None, database: str | None = None,
        history_in_place: bool = False) -> RunReport:
    """``history_in_place``: ``execution`` was read from this ``out_dir``. ``load_table`` gives the participating tables that rules name and ``tables`` lacks;
    with ``database`` every planned object must be registered under it (W5)."""
    clock = clock or RunClock.utcnow()
    plan_rows = rule_plan(catalog, object_ids).collect()  # catalog-sized
    if database is not None:
        check_database(plan_rows, database)
    plans = group_plan(plan_rows)
    report = RunReport(out_dir, [p.object_id for p in plans])
    if not plans:
        return report
    objects = catalog.object_lookup.where(F.col("Object_ID").isin(report.objects))
    run_ids = W.next_run_ids(object_log, objects, clock)
    windows = W.next_windows(objects, execution, clock, run_ids, job_id)
    window_rows = {r["Object_ID"]: r for r in windows.collect()}  # one row per object
    write_results(W.execution_rows(windows, clock), f"{out_dir}/execution", partition_by=())
    report.actions += 2

    tables = dict(tables or {})
    if load_table is not None:
        for name in dict.fromkeys(t for p in plans for t in p.participating):
            tables.setdefault(name, load_table(name))
    register_tables(tables)
    results: list[Evaluated] = []
    for p in plans:
        w = window_rows[p.object_id]
        full = (p.validation_period or "").lower() == W.FULL_TABLE
        start, end = w["Val_St_Dt"], w["Val_End_Dt"]
        try:
            if not full and not w["_known_period"]:
                raise ValueError(f"unknown validation period {p.validation_period!r} and no Time_Interval")
            if not full and not p.date_col:
                raise ValueError("an incremental window needs Source_Table_Date_Col on the object's mappings")
            source = loader(p)
            if not full:
                source = windowed(source, p.date_col, start, end)
            one = ObjectRun(p.object_id, p.object_name, p.primary_key, source, p.mappings, clock,
                            run_id=int(w["Run_Id"]), window=(start, end), tables=tables,
                            declared=(declared or {}).get(p.object_id), thresholds=catalog.rule_threshold)
            results.append((p, one, validate(spark, one)))
        except Exception as exc:  # noqa: BLE001 - one object's failure does not stop the others
            report.failed_objects[p.object_id] = _short(exc)

    try:
        results, runs, counts = _write_detailed(spark, results, out_dir, clock, report)
        for p, _, r in results:
            if p.mappings and not r.mapping_ids:
                report.failed_objects[p.object_id] = "none of the object's rules could be evaluated"
        if results:
            _write_summaries(spark, results, runs, counts, catalog, out_dir, clock, alert_mode)
            commits.commit(spark, out_dir, runs, clock)
            commits.remove_replaced(spark, out_dir, runs, clock)
            report.actions += 6
    except Exception as exc:
        for p, _, _ in results:
            report.failed_objects[p.object_id] = _short(exc)
        raise
    finally:
        _close_states(spark, plans, window_rows, None if history_in_place else execution, out_dir, clock, report)
    return report


def _write_detailed(spark: SparkSession, results: list[Evaluated], out_dir: str, clock: RunClock,
                    report: RunReport) -> tuple[list[Evaluated], Runs, dict[int, int]]:
    """Write the failures of all objects; returns what was written, without what cannot run, the attempts it was
    written under, and the failures per mapping."""
    def write(parts: list[Evaluated]) -> tuple[Runs, dict[int, int]]:
        attempt = commits.new_attempt(clock)  # of each write: what a failed one left is nobody's
        runs = [(p.object_id, r.run_id, attempt) for p, _, r in parts]
        mappings = sum(len(r.mapping_ids) for _, _, r in parts)
        counting = Counting(F.col("Mapping_ID"), mappings) if mappings <= MAX_COUNTED else None
        frame = commits.with_attempt(_union([r.detailed for _, _, r in parts]), runs)
        write_results(frame, f"{out_dir}/detailed", partition_by=commits.PARTITIONS, counting=counting)
        if counting is not None:
            return runs, counting.counts()
        back = _read_back(spark, f"{out_dir}/detailed", frame.schema).where(F.col(commits.ATTEMPT) == attempt)
        return runs, {r["Mapping_ID"]: r["count"] for r in back.groupBy("Mapping_ID").count().collect()}

    if not results:
        return [], [], {}
    try:
        return results, *write(results)
    except Exception:  # noqa: BLE001 - some object's plan; each is now tried alone
        pass
    written, runs, counts = [], [], {}
    for p, one, r in results:
        try:
            try:
                done = write([(p, one, r)])
            except Exception:  # noqa: BLE001 - some check of this object
                one.broken.update(broken_checks(r))
                r = validate(spark, one)
                done = write([(p, one, r)])
            written.append((p, one, r))
            runs += done[0]
            counts |= done[1]
        except Exception as exc:  # noqa: BLE001 - the object itself cannot be read
            report.failed_objects[p.object_id] = _short(exc)
    return written, runs, counts


def _write_summaries(spark: SparkSession, results: list[Evaluated], runs: Runs, found: dict[int, int], catalog: Catalog,
                     out_dir: str, clock: RunClock, alert_mode: str) -> None:
    """Aggregates, object log, rule errors and alerts, each one frame for all objects."""
    row_counts = _union([one.source.agg(F.lit(p.object_id).cast("int").alias("Object_ID"),
                                        F.count(F.lit(1)).cast("long").alias("Row_Count")) for p, one, _ in results])
    evaluated = [(p, r, m) for p, _, r in results for m in p.mappings if m.mapping_id in set(r.mapping_ids)]
    failures = local_frame(spark, [(m.mapping_id, p.object_id, found.get(m.mapping_id, 0)) for p, _, m in evaluated],
                           "Mapping_ID int, Object_ID int, Failure_Count long")
    # one row per mapping / object: catalog-sized, broadcast
    counts = (F.broadcast(failures).join(F.broadcast(row_counts), "Object_ID")
              .select("Mapping_ID", "Failure_Count", "Row_Count"))
    meta = mapping_meta(spark, [(p.object_name, r.run_id, m) for p, r, m in evaluated])
    # One row per mapping, computed once: the aggregated table, its alerts and their recipients are made of it.
    computed = summary.aggregated_rows(counts, meta, catalog.rule_threshold, clock.now)
    aggregated = local_frame(spark, computed.collect(), computed.schema)

    def write(frame: DataFrame, table: str) -> None:
        if "Period" not in frame.columns:
            frame = frame.withColumn("Period", date_lit(clock.period))
        commits.write_attempt(frame, f"{out_dir}/{table}", runs)

    write(aggregated, "aggregated")
    write(_union([r.object_log for _, _, r in results]).withColumn("Run_ID", F.col("Object_Log_ID")), "object_log")
    write(_union([r.rule_errors.withColumn("Run_ID", F.lit(r.run_id).cast("int")) for _, _, r in results]), "rule_errors")
    differing = [schema_diff(spark, one.source, declared_list(one.declared), p.object_id)
                 .withColumn("Run_ID", F.lit(r.run_id).cast("int")) for p, one, r in results if one.declared is not None]
    if differing:  # S9: columns missing from or beyond the declared schema
        write(_union(differing), "schema_findings")
    alerts = alert_ops.alert_rows(aggregated, catalog, alert_mode)
    write(alerts, "alerts")
    alert_ops.write_extracts(alerts, f"{out_dir}/extracts/{clock.now:%Y%m%dT%H%M%S}", mode="overwrite")
    write(alert_ops.recipients(aggregated, catalog, alert_mode), "alert_recipients")


def _close_states(spark: SparkSession, plans: list[ObjectPlan], window_rows: dict, execution: DataFrame | None,
                  out_dir: str, clock: RunClock, report: RunReport) -> None:
    # An object none of whose rules could be evaluated was not validated.
    outcomes = [(p.object_id, int(window_rows[p.object_id]["Run_Id"]),
                 "Failure" if p.object_id in report.failed_objects else "Success") for p in plans]
    outcome_df = local_frame(spark, outcomes, "Object_ID int, Run_Id int, Val_Status string")
    history = _read_back(spark, f"{out_dir}/execution", schemas.EXECUTION)
    if execution is not None:  # a resumed window's 'Executing' row lives in the given history
        history = history.unionByName(execution.select(*schemas.EXECUTION.fieldNames()))
    write_results(W.status_rows(history, outcome_df, clock), f"{out_dir}/execution", partition_by=())
    report.actions += 1


def _read_back(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a result table with its known schema: a write of no rows leaves no
    data files, and the read must then give an empty frame, not fail."""
    return spark.read.schema(schema).parquet(path)


def _short(exc: Exception) -> str:
    return (str(exc).strip().splitlines() or [type(exc).__name__])[0][:500]


def read_result(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """A result or state table of earlier runs. Result tables are read through the commit log: the rows of each
    object run's last committed attempt. The state tables ``execution`` and ``object_log`` are held apart
    from what is written to them from now on."""
    if table not in ("execution", "object_log"):
        return commits.read_committed(spark, out_dir, table)
    rows = (_read_back(spark, f"{out_dir}/execution", schemas.EXECUTION) if table == "execution"
            else commits.read_committed(spark, out_dir, table))
    # Catalog-sized: one or two rows per object and run.
    return local_frame(spark, rows.collect(), rows.schema)


def empty_execution(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [], schemas.EXECUTION)


def current_results(spark: SparkSession, out_dir: str, table: str = "detailed") -> DataFrame:
    """Rows of a result table that belong to the last committed attempt of each object run."""
    return commits.read_committed(spark, out_dir, table)
