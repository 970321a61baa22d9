"""File-arrival validation as a Structured Streaming job.

Arriving files are read by Spark's file stream source; each row carries its
file path (``_metadata.file_path``), the file name gives the table id (text
between the last ``/`` and the last ``.``), and a left-semi join with the
object registry keeps only registered tables. A file is a closed set, so
uniqueness and counts are per file and no watermark is needed: the file is a
scope of the batch validator, so a micro-batch is one plan per registered
object whatever its number of files. Results carry the file and its run id
(1 + the highest run id logged for the object on the clock's day).

Results of a micro-batch are written under ``batch=<epoch id>`` with overwrite,
so a re-run of the same epoch after a failure replaces its output instead of
duplicating it; offsets live in the stream's checkpoint location. States
(Executing, then Success or Failure) are written per file the same way.

Each object of a micro-batch is judged for itself: one that cannot be validated (a missing
key column, rows that cannot be read, no rule that can be evaluated) closes its files as
``Failure`` with the error in ``rule_errors``; the others are written and the stream goes on.
Records that do not fit the schema (another number of fields, a value of another type, broken
JSON) are no rows to be judged: they go to ``schema_findings`` with their file and number, from
the same reading of the files. Failures are counted per file and mapping in the write of the detailed rows, so key, lookup and
SQL checks run once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera import schemas
from tessera.clock import RunClock
from tessera.functions.local import local_frame
from tessera.functions.paths import extension, table_id
from tessera.functions.projection import ts_lit
from tessera.operators import alerts, summary
from tessera.operators.fused import SCOPE
from tessera.plans.catalog import ObjectPlan
from tessera.plans.engine import ObjectRun, ValidationResult, broken_checks, mapping_meta, validate
from tessera.sources.readers import CORRUPT, malformed_findings, permissive
from tessera.sources.sinks import MAX_COUNTED, Counting

FILE_COL, TABLE_COL = "_source_file", "_table_id"


@dataclass
class FileBatch:
    """The objects of a micro-batch: judged ones, and those that could not be, with their files and error."""
    judged: list[tuple[ObjectPlan, ObjectRun, ValidationResult]] = field(default_factory=list)
    failed: list[tuple[ObjectPlan, list[tuple[str, int]], str]] = field(default_factory=list)
    findings: list[DataFrame] = field(default_factory=list)


def arrivals(spark: SparkSession, landing_dir: str, fmt: str, schema: T.StructType,
             options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**(options or {}))
    # Text formats keep what they cannot read; others have no malformed records.
    reader = permissive(reader, schema) if fmt in ("csv", "json") else reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(landing_dir)
    path = F.col("_metadata.file_path")
    return df.withColumn(FILE_COL, path).withColumn(TABLE_COL, table_id(path)).withColumn(
        "_extension", extension(path))


def registered(stream: DataFrame, objects: DataFrame) -> DataFrame:
    """Keep rows of files whose table id (and extension, when set) names an active object."""
    active = objects.where(F.col("Active") == 1) if "Active" in objects.columns else objects
    reg = active.select(F.col("Object_Name").alias("_reg_name"),
                        F.lower(F.col("Object_Extension")).alias("_reg_ext"))
    cond = (stream[TABLE_COL] == reg["_reg_name"]) & (
        reg["_reg_ext"].isNull() | (stream["_extension"] == reg["_reg_ext"]))
    return stream.join(reg, cond, "left_semi")


def last_run_ids(spark: SparkSession, out_dir: str, epoch_id: int, clock: RunClock) -> dict[int, int]:
    """Highest run id per object logged on the clock's day by other micro-batches."""
    try:
        log = spark.read.parquet(f"{out_dir}/object_log")
    except AnalysisException:  # nothing logged yet
        return {}
    if "batch" not in log.columns:
        return {}
    today = log.where((F.to_date("Last_Update_Date") == F.lit(clock.period.isoformat()).cast("date"))
                      & (F.col("batch") != epoch_id))
    return {r[0]: r[1] for r in today.groupBy("Object_ID").agg(F.max("Object_Log_ID")).collect()}


def _short(exc: Exception) -> str:
    return (str(exc).strip().splitlines() or [type(exc).__name__])[0][:500]


def validate_file_batch(spark: SparkSession, batch: DataFrame, plans: list[ObjectPlan], clock: RunClock,
                        last_ids: dict[int, int], thresholds: DataFrame | None = None,
                        declared: dict[int, object] | None = None) -> FileBatch:
    """One validation per object over all its files of a micro-batch.

    The driver holds the names of the batch's files, one short row each.
    """
    arrived: dict[str, list[str]] = {}
    for table, path in sorted(map(tuple, batch.select(TABLE_COL, FILE_COL).distinct().collect())):
        arrived.setdefault(table, []).append(path)
    found = FileBatch()
    for plan in plans:
        files = arrived.get(plan.object_name)
        if not files:
            continue
        first = last_ids.get(plan.object_id, 0) + 1
        runs = [(path, first + i) for i, path in enumerate(files)]
        try:
            rows = batch.where(F.col(TABLE_COL) == plan.object_name)
            if CORRUPT in batch.columns:
                found.findings.append(malformed_findings(rows, plan.object_id, FILE_COL).withColumnRenamed("_file", SCOPE))
                rows = rows.where(F.col(CORRUPT).isNull())
            names = [c for c in batch.columns if not c.startswith("_") or c == FILE_COL]
            one = ObjectRun(plan.object_id, plan.object_name, plan.primary_key, rows.select(*names), plan.mappings, clock,
                            thresholds=thresholds, declared=(declared or {}).get(plan.object_id), emit_empty=False,
                            scope=FILE_COL, scope_runs=runs)
            found.judged.append((plan, one, validate(spark, one)))
        except Exception as exc:  # noqa: BLE001 - one object's files do not stop the others
            found.failed.append((plan, runs, _short(exc)))
    return found


def _isolate(spark: SparkSession, found: FileBatch) -> None:
    """After a joint write failed: run each object alone, move its broken checks to ``rule_errors``, and give up
    the objects that cannot run at all."""
    runs = lambda r: r.detailed.write.format("noop").mode("overwrite").save()
    judged, found.judged = found.judged, []
    for plan, one, r in judged:
        try:
            try:
                runs(r)
            except Exception:  # noqa: BLE001 - some check of this object
                one.broken.update(broken_checks(r))
                r = validate(spark, one)
                runs(r)
            found.judged.append((plan, one, r))
        except Exception as exc:  # noqa: BLE001 - the object itself cannot be read
            found.failed.append((plan, one.scope_runs, _short(exc)))


def _write_detailed(spark: SparkSession, found: FileBatch, path: str) -> DataFrame:
    """Write the failing rows of all objects; returns (Mapping_ID, file, Failure_Count) as counted by the write."""
    schema = f"Mapping_ID int, {SCOPE} string, Failure_Count long"
    files = {(plan.object_id, run_id): name for plan, one, _ in found.judged for name, run_id in one.scope_runs}
    detailed = reduce(lambda a, b: a.unionByName(b), [r.detailed for _, _, r in found.judged])
    items = sum(len(r.mapping_ids) * len(one.scope_runs) for _, one, r in found.judged)
    counting = Counting(F.concat_ws(" ", "Mapping_ID", "Object_ID", "Run_ID"), items) if items <= MAX_COUNTED else None
    rows = detailed.hint("rebalance")
    (counting.of(rows) if counting else rows).write.mode("overwrite").parquet(path)
    if counting is None:
        return (spark.read.schema(detailed.schema).parquet(path).groupBy("Mapping_ID", SCOPE)
                .agg(F.count(F.lit(1)).alias("Failure_Count")))
    counts = [(*map(int, item.split(" ")), n) for item, n in counting.counts().items()]
    return local_frame(spark, [(mapping, files[object_id, run_id], n) for mapping, object_id, run_id, n in counts], schema)


def _aggregated(spark: SparkSession, found: FileBatch, failures: DataFrame, clock: RunClock) -> DataFrame:
    """One row per mapping and file, from the failures counted by the write and one row count per file."""
    rows = reduce(lambda a, b: a.unionByName(b), [
        one.source.groupBy(F.col(one.scope).alias(SCOPE)).agg(F.count(F.lit(1)).cast("long").alias("Row_Count"))
        .withColumn("Object_ID", F.lit(plan.object_id).cast("int")) for plan, one, _ in found.judged])
    evaluated = [(plan, r, m) for plan, _, r in found.judged for m in plan.mappings if m.mapping_id in set(r.mapping_ids)]
    mappings = local_frame(spark, [(m.mapping_id, plan.object_id) for plan, _, m in evaluated], "Mapping_ID int, Object_ID int")
    counts = (rows.join(F.broadcast(mappings), "Object_ID").join(F.broadcast(failures), ["Mapping_ID", SCOPE], "left")
              .select("Mapping_ID", SCOPE, F.coalesce("Failure_Count", F.lit(0)).cast("long").alias("Failure_Count"), "Row_Count"))
    meta = mapping_meta(spark, [(plan.object_name, 0, m) for plan, _, m in evaluated])
    scope_runs = local_frame(spark, [x for _, one, _ in found.judged for x in one.scope_runs], f"{SCOPE} string, Run_ID int")
    thresholds = found.judged[0][1].thresholds
    return summary.aggregated_rows(counts, meta, thresholds, clock.now, False, scope_runs)


def _write_batch(spark: SparkSession, found: FileBatch, out_dir: str, epoch_id: int, clock: RunClock, catalog=None,
                 alert_mode: str = "equal") -> None:
    path = lambda name: f"{out_dir}/{name}/batch={epoch_id}"

    def write(frame: DataFrame, name: str) -> None:
        frame.write.mode("overwrite").parquet(path(name))

    failures = None
    if found.judged:
        try:
            failures = _write_detailed(spark, found, path("detailed"))
        except Exception:  # noqa: BLE001 - some object or check that fails when it runs; the others are written
            _isolate(spark, found)
            failures = _write_detailed(spark, found, path("detailed")) if found.judged else None
    errors = [(plan.object_id, None, None, None, "object", error) for plan, _, error in found.failed]
    frames = [r.rule_errors for _, _, r in found.judged] + ([local_frame(spark, errors, schemas.RULE_ERRORS)] if errors else [])
    if frames:
        write(reduce(lambda a, b: a.unionByName(b), frames), "rule_errors")
    if found.findings:
        write(reduce(lambda a, b: a.unionByName(b), found.findings), "schema_findings")
    if failures is not None:
        aggregated = _aggregated(spark, found, failures, clock)
        write(aggregated, "aggregated")
        write(reduce(lambda a, b: a.unionByName(b), [r.object_log for _, _, r in found.judged]), "object_log")
        if catalog is not None:  # alerts on the file path too, from the aggregates just written
            written = spark.read.schema(aggregated.schema).parquet(path("aggregated"))
            write(alerts.alert_rows(written, catalog, alert_mode), "alerts")
            write(alerts.recipients(written, catalog, alert_mode), "alert_recipients")
    # A file none of whose object's rules could be evaluated was not validated.
    closed = [(plan, one.scope_runs, "Success" if r.mapping_ids or not plan.mappings else "Failure") for plan, one, r in found.judged]
    closed += [(plan, runs, "Failure") for plan, runs, _ in found.failed]
    states = [(plan.object_id, run_id, name, status) for plan, runs, end in closed for name, run_id in runs for status in ("Executing", end)]
    write(local_frame(spark, states, f"Object_ID int, Run_Id int, {SCOPE} string, Val_Status string")
          .withColumn("Last_Upd_Dt", ts_lit(clock.now)), "execution")


def start(spark: SparkSession, landing_dir: str, fmt: str, schema: T.StructType, plan: ObjectPlan | list[ObjectPlan],
          objects: DataFrame, out_dir: str, checkpoint_location: str,
          clock_fn: Callable[[], RunClock] = RunClock.utcnow, thresholds: DataFrame | None = None,
          declared: dict[int, object] | None = None, options: dict | None = None, available_now: bool = True,
          max_files_per_trigger: int | None = None, catalog=None, alert_mode: str = "equal") -> StreamingQuery:
    """Validate arriving files of the given objects. One stream reads one format and schema; objects that
    share them share the stream."""
    plans = plan if isinstance(plan, list) else [plan]
    stream = registered(arrivals(spark, landing_dir, fmt, schema, options, max_files_per_trigger), objects)
    stream = stream.where(F.col(TABLE_COL).isin([p.object_name for p in plans]))

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        clock = clock_fn()
        # Read several times while it is judged; recomputed from its files if an executor is lost.
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            last = last_run_ids(spark, out_dir, epoch_id, clock)
            found = validate_file_batch(spark, batch, plans, clock, last, thresholds, declared)
            if found.judged or found.failed:
                _write_batch(spark, found, out_dir, epoch_id, clock, catalog, alert_mode)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
