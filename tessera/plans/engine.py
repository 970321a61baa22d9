"""Validation of one object for one run: checks -> detailed, aggregated, log, errors.

Plan shape (see README): all row-local checks share one scan (``fused``); each
key, lookup, SQL, Python or business check adds one plan of its own; the type
check is metadata only. Counts for every row-local check and the row count of
the window come from one aggregate. Nothing is collected from the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.clock import RunClock
from tessera.functions import predicates as P
from tessera.functions.local import local_frame
from tessera.functions.projection import date_lit, label_text, split_names, ts_lit
from tessera.operators import keys, lookups, schema_check, sqlrules, summary
from tessera.operators.fused import (ACTUAL, PK_VALUE, SCOPE, CompiledCheck, MissingColumnError, any_failing,
                                     column_types, compile_check, fused_counts, fused_failures,
                                     resolve)
from tessera.operators.spec import Check, Mapping, RuleError, expand

FAILURE_COLUMNS = [PK_VALUE, "Mapping_ID", "Rule_ID", "Object_ID", "Column_Name", ACTUAL]
# Stable projection of the detailed table (all but the clock stamps).
REPORT_COLUMNS = ["Mapping_ID", "Rule_ID", "Object_ID", "Run_ID", "Column_Name",
                  "Primary_Key_Column_s_", PK_VALUE, ACTUAL]


@dataclass
class ObjectRun:
    object_id: int
    object_name: str
    primary_key: str
    source: DataFrame
    mappings: list[Mapping]
    clock: RunClock
    run_id: int = 1
    window: tuple[dt.datetime | None, dt.datetime | None] = (None, None)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    declared: object = None
    thresholds: DataFrame | None = None
    strict_types: bool = False
    emit_empty: bool = True
    scope: str | None = None  # a column of the source whose values are closed sets (files), judged each by itself
    scope_runs: list[tuple[str, int]] = field(default_factory=list)  # with scope: (value, run id) of each
    broken: dict[int, str] = field(default_factory=dict)  # Mapping_ID -> why it failed at run time; not evaluated


@dataclass
class ValidationResult:
    failures: DataFrame
    counts: DataFrame
    detailed: DataFrame
    aggregated: DataFrame
    object_log: DataFrame
    rule_errors: DataFrame
    compiled: list[CompiledCheck]
    frames: list[tuple[Mapping, DataFrame]]
    pk_cols: list[str]
    run_id: int = 1
    mapping_ids: list[int] = field(default_factory=list)
    passes: list[Callable[[DataFrame], DataFrame]] = field(default_factory=list)  # each drops one check's failing rows

    def report(self) -> DataFrame:
        return self.detailed.select(*REPORT_COLUMNS)


def invalid_patterns(spark: SparkSession, patterns: list[str]) -> dict[str, str]:
    """Regexes that Java cannot compile, probed on a one-row local relation.

    The probe is folded while planning, so no Spark job runs; patterns are
    probed one by one only when the joint probe fails.
    """
    unique = list(dict.fromkeys(patterns))
    if not unique:
        return {}
    one = local_frame(spark, [("",)], "s string")
    probe = lambda ps: one.select(*[F.col("s").rlike(p) for p in ps]).collect()
    try:
        probe(unique)
        return {}
    except Exception:  # noqa: BLE001 - any failure means at least one bad pattern
        pass
    bad = {}
    for p in unique:
        try:
            probe([p])
        except Exception as exc:  # noqa: BLE001
            bad[p] = str(exc).splitlines()[0][:300]
    return bad


def _stamp(frame: DataFrame, m: Mapping) -> DataFrame:
    return frame.select(
        F.col(PK_VALUE).cast("string").alias(PK_VALUE),
        F.lit(m.mapping_id).cast("int").alias("Mapping_ID"),
        F.lit(m.rule_id).cast("int").alias("Rule_ID"),
        F.lit(m.object_id).cast("int").alias("Object_ID"),
        F.lit(m.column_name).cast("string").alias("Column_Name"),
        F.col(ACTUAL).cast("string").alias(ACTUAL),
        *([SCOPE] if SCOPE in frame.columns else []),
    )


def _error_frame(spark: SparkSession, errors: list[RuleError]) -> DataFrame:
    rows = [(e.mapping.object_id, e.mapping.mapping_id, e.mapping.rule_id, e.mapping.column_name,
             e.key, e.error) for e in errors]
    return local_frame(spark, rows, schemas.RULE_ERRORS)


def _short(exc: Exception) -> str:
    return str(exc).strip().splitlines()[0][:500] if str(exc).strip() else type(exc).__name__


def _schema_check(spark, run: ObjectRun, check: Check, types, today, now, compiled, frames, errors):
    declared = schema_check.declared_list(run.declared)
    if not declared:
        errors.append(RuleError(check.mapping, "data_type", "no declared schema for this object"))
        return
    scope = schema_check.restrict(declared, check.columns)
    found = schema_check.type_mismatches(run.source, scope, strict=run.strict_types)
    rows = [(message, column) for column, message in found]
    frame = local_frame(spark, rows, f"{PK_VALUE} string, {ACTUAL} string")
    if run.scope:  # the files of an object share their schema: a finding for each
        frame = local_frame(spark, [(*row, value) for row in rows for value, _ in run.scope_runs],
                            f"{PK_VALUE} string, {ACTUAL} string, {SCOPE} string")
    frames.append((check.mapping, frame))
    for column in schema_check.required_columns(scope):
        if column.lower() in types:
            compiled.append(compile_check(Check(check.mapping, "is_nullable", "NO", (column,)),
                                          types, today, now))


def mapping_meta(spark: SparkSession, rows: list[tuple[str, int, Mapping]]) -> DataFrame:
    """(object name, run id, mapping) as the frame the aggregate rows are labelled from."""
    return local_frame(spark, [(m.mapping_id, m.rule_id, m.object_id, m.column_name, name, m.rule_description, run_id)
                               for name, run_id, m in rows],
                       "Mapping_ID int, Rule_ID int, Object_ID int, Column_Name string, Object_Name string, "
                       "Rule_Description string, Run_ID int")


def validate(spark: SparkSession, run: ObjectRun) -> ValidationResult:
    checks, errors = expand([m for m in run.mappings if m.mapping_id not in run.broken])
    errors += [RuleError(m, "run", run.broken[m.mapping_id]) for m in run.mappings if m.mapping_id in run.broken]
    source = run.source
    types = column_types(source)
    pk_cols = split_names(run.primary_key)
    missing_pk = [c for c in pk_cols if c.lower() not in types]
    if missing_pk:  # an object-level error: no failing row could be identified
        raise MissingColumnError(f"primary key column(s) {missing_pk} not in object {run.object_name!r}")
    today, now = run.clock.period, run.clock.now
    window_start, window_end = run.window

    bad_regex = invalid_patterns(spark, [c.value for c in checks
                                         if c.key == "regex" and isinstance(c.value, str)])
    compiled: list[CompiledCheck] = []
    frames: list[tuple[Mapping, DataFrame]] = []
    passes: list[Callable[[DataFrame], DataFrame]] = []
    for check in checks:
        m = check.mapping
        try:
            kind = check.kind
            if kind == "row":
                if check.key == "regex" and check.value in bad_regex:
                    raise P.RuleValueError(f"invalid regex: {bad_regex[check.value]}")
                compiled.append(compile_check(check, types, today, now))
            elif kind == "key":
                for c in list(check.columns) + pk_cols:
                    resolve(types, c)
                key_cols = list(check.columns)
                frames.append((m, keys.duplicate_failures(source, key_cols, pk_cols, run.scope)))
                passes.append(lambda df, c=key_cols: keys.rows_without_duplicates(df, c, among=source))
            elif kind == "lookup":
                if len(check.columns) != 1:
                    raise P.RuleValueError("lookup tests take exactly one column")
                column = check.columns[0]
                lookup = (column, resolve(types, column), check.value, check.key == "forbidden")
                frames.append((m, lookups.lookup_failures(source, *lookup, pk_cols, run.tables, run.scope)))
                passes.append(lambda df, a=lookup: lookups.passing_rows(df, *a, run.tables))
            elif kind == "sql":
                failing = sqlrules.custom_sql_failures(spark, source, check.value)
                frames.append((m, sqlrules.project_failures(failing, pk_cols, list(check.columns), run.scope)))
                passes.append(lambda df, bad=failing: without_keys(df, bad, pk_cols))
            elif kind == "python":
                failing = sqlrules.python_failures(source, check.value)
                frames.append((m, sqlrules.project_failures(failing, pk_cols, list(check.columns), run.scope)))
                passes.append(lambda df, bad=failing: without_keys(df, bad, pk_cols))
            elif kind == "business":
                failing = sqlrules.business_failures(spark, check.value, window_start, window_end)
                frames.append((m, sqlrules.project_failures(failing, pk_cols, list(check.columns), run.scope)))
                passes.append(lambda df, bad=failing: without_keys(df, bad, pk_cols))
            elif kind == "schema":
                _schema_check(spark, run, check, types, today, now, compiled, frames, errors)
        except (MissingColumnError, P.RuleValueError, lookups.LookupError_, sqlrules.SqlRuleError,
                PySparkException) as exc:
            errors.append(RuleError(m, check.key, _short(exc)))

    evaluated = {c.check.mapping.mapping_id for c in compiled} | {m.mapping_id for m, _ in frames}
    failed_only = {e.mapping.mapping_id for e in errors} - evaluated
    mapping_ids = [m.mapping_id for m in run.mappings if m.mapping_id not in failed_only]

    parts = [fused_failures(source, compiled, pk_cols, run.scope)] if compiled else []
    parts += [_stamp(frame, m) for m, frame in frames]
    if parts:
        failures = reduce(lambda a, b: a.unionByName(b), parts)
    else:
        failures = local_frame(spark, [], ", ".join(
            f"{c} {'int' if c.endswith('_ID') else 'string'}" for c in FAILURE_COLUMNS + ([SCOPE] if run.scope else [])))

    counts = fused_counts(source, compiled, mapping_ids, run.scope)
    of_scope = [SCOPE] if run.scope else []
    for m, frame in frames:
        counts = counts.unionByName(frame.groupBy(*of_scope).agg(
            F.lit(m.mapping_id).cast("int").alias("Mapping_ID"),
            F.count(F.lit(1)).cast("long").alias("Failure_Count"),
            F.lit(None).cast("long").alias("Row_Count")))

    scope_runs = local_frame(spark, run.scope_runs, f"{SCOPE} string, Run_ID int") if run.scope else None
    if run.scope:
        failures = failures.join(F.broadcast(scope_runs), SCOPE)
    else:
        failures = failures.withColumn("Run_ID", F.lit(run.run_id).cast("int"))
    detailed = failures.select(
        F.col(PK_VALUE), F.col(ACTUAL), F.col("Run_ID"),
        date_lit(today).alias("Period"),
        F.col("Object_ID"), F.col("Rule_ID"), F.col("Mapping_ID"), F.col("Column_Name"),
        F.lit(label_text(pk_cols)).alias("Primary_Key_Column_s_"),
        ts_lit(now).alias("Last_Update_Date"), *of_scope,
    )

    meta = mapping_meta(spark, [(run.object_name, run.run_id, m) for m in run.mappings if m.mapping_id in set(mapping_ids)])
    aggregated = summary.aggregated_rows(counts, meta, run.thresholds, now, run.emit_empty, scope_runs)

    logged = local_frame(spark, [(run.run_id, run.object_id, run.object_name)],
                         "Object_Log_ID int, Object_ID int, Object_Name string")
    if run.scope:  # a log row per file
        logged = scope_runs.select(F.col("Run_ID").alias("Object_Log_ID"), F.lit(run.object_id).cast("int").alias("Object_ID"),
                                       F.lit(run.object_name).alias("Object_Name"), SCOPE)
    object_log = logged.select(
        "Object_Log_ID", date_lit(today).alias("Period"), "Object_ID", "Object_Name",
        ts_lit(now).alias("Last_Update_Date"),
        ts_lit(window_start).alias("val_st_dt"), ts_lit(window_end).alias("val_end_dt"), *of_scope)

    return ValidationResult(failures, counts, detailed, aggregated, object_log,
                            _error_frame(spark, errors), compiled, frames, pk_cols, run.run_id,
                            mapping_ids, passes)


def broken_checks(result: ValidationResult) -> dict[int, str]:
    """Checks of their own plan that fail when they run, found by running them one by one."""
    broken = {}
    for m, frame in result.frames:
        try:
            frame.write.format("noop").mode("overwrite").save()
        except Exception as exc:  # noqa: BLE001 - whatever a rule's query may raise
            broken[m.mapping_id] = _short(exc)
    return broken


def without_keys(df: DataFrame, failing: DataFrame, pk_cols: list[str]) -> DataFrame:
    """Rows of ``df`` whose primary key is not among the failing rows' (typed, NULL equal to NULL)."""
    bad = failing.select(*[F.col(c).alias(f"_bad{i}") for i, c in enumerate(pk_cols)])
    same = reduce(and_, [df[c].eqNullSafe(bad[f"_bad{i}"]) for i, c in enumerate(pk_cols)])
    return df.join(bad, same, "left_anti")


def passing_rows(source: DataFrame, result: ValidationResult) -> DataFrame:
    """Input rows with no reported failure.

    Row-local checks are excluded by negating the fused condition (no join), key
    and lookup checks by the row's own values, so rows with NULL, composite or
    repeated primary keys are judged one by one. SQL, Python and business checks
    report keys only: all rows that share a failing key are held back.
    """
    keep = source
    if result.compiled:
        keep = keep.where(~any_failing(result.compiled))
    for drop_failing in result.passes:
        keep = drop_failing(keep)
    return keep
