"""Per-mapping summary: failure count, percent and criticality.

Inputs are per-check counts ``(Mapping_ID, Failure_Count, Row_Count)``; one
mapping may have several checks, whose counts add up (a row failing two checks
counts twice, as it appears twice in the detailed output). Everything here is
one row per mapping, so the joins are small; Spark broadcasts the catalog side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.projection import date_lit, ts_lit
from tessera.operators.fused import SCOPE


def _unit(frame: DataFrame) -> list[str]:
    """What a total belongs to: the mapping, and the file where several are judged at once."""
    return ["Mapping_ID"] + ([SCOPE] if SCOPE in frame.columns else [])


def totals(counts: DataFrame) -> DataFrame:
    return (counts.groupBy(*_unit(counts))
            .agg(F.sum("Failure_Count").cast("long").alias("Failure_Count"),
                 F.max("Row_Count").cast("long").alias("Row_Count")))


def failure_percent(k: str = "Failure_Count", n: str = "Row_Count"):
    """A5: failures / rows, 0.0 when either is 0 (or unknown)."""
    return (F.when((F.col(n) > 0) & (F.col(k) > 0), F.col(k) / F.col(n))
            .otherwise(F.lit(0.0)).cast("double"))


def active_thresholds(thresholds: DataFrame) -> DataFrame:
    t = thresholds
    if "Active" in t.columns:
        t = t.where(F.col("Active") == 1)
    return (t.select(F.col("Mapping_ID").cast("int").alias("Mapping_ID"),
                     F.col("Failure_Threshold_Value").cast("double").alias("_threshold"),
                     F.col("Criticality").cast("int").alias("_tier"))
            .dropna())


def criticality(summary: DataFrame, thresholds: DataFrame | None) -> DataFrame:
    """The highest tier whose threshold <= percent; only when there are failures.

    Ties on the threshold resolve to the higher tier. The thresholds (catalog
    size) are broadcast to the per-mapping totals and folded in one aggregate
    on ``Mapping_ID``, the totals' own partitioning, so the totals are computed
    once and nothing is shuffled again.
    """
    if thresholds is None:
        return summary.withColumn("Criticality", F.lit(None).cast("int"))
    fires = (F.col("Failure_Count") > 0) & (F.col("_threshold") <= F.col("Failure_Percent"))
    unit = _unit(summary)
    others = [c for c in summary.columns if c not in unit]
    return (summary.join(F.broadcast(active_thresholds(thresholds)), "Mapping_ID", "left")
            .groupBy(*unit)
            .agg(*[F.first(c).alias(c) for c in others],
                 F.max(F.when(fires, F.struct("_threshold", "_tier")))["_tier"].alias("Criticality")))


def aggregated_rows(counts: DataFrame, meta: DataFrame, thresholds: DataFrame | None,
                    now: dt.datetime, emit_empty: bool = True, scope_runs: DataFrame | None = None) -> DataFrame:
    """The 12-column aggregate row per mapping; ``meta`` holds the mappings of any number of objects.
    With files, a row per mapping and file, its run id from ``scope_runs``, and the file as a column."""
    s = totals(counts).withColumn("Failure_Percent", failure_percent())
    if not emit_empty:
        s = s.where(F.col("Row_Count") > 0)
    s = criticality(s, thresholds)
    s = F.broadcast(meta).join(F.broadcast(s), "Mapping_ID")
    if scope_runs is not None:
        s = s.drop("Run_ID").join(F.broadcast(scope_runs), SCOPE)
    return s.select(
        ts_lit(now).alias("Last_Update_Date"),
        F.col("Failure_Percent"),
        F.coalesce(F.col("Failure_Count"), F.lit(0)).cast("long").alias("Failure_Count"),
        F.col("Column_Name").cast("string"),
        F.col("Mapping_ID").cast("int"),
        F.col("Rule_ID").cast("int"),
        F.col("Object_ID").cast("int"),
        date_lit(now.date()).alias("Period"),
        F.col("Run_ID").cast("int"),
        F.col("Criticality").cast("int"),
        F.col("Object_Name").cast("string"),
        F.col("Rule_Description").cast("string"),
        *([SCOPE] if scope_runs is not None else []),
    )
