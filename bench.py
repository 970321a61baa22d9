"""Benchmark: headline validation workloads on the test tables.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line. Each workload is executed to completion through the
``noop`` sink (no driver collection). Besides wall time, the Spark jobs each
workload starts are counted, to show that the fused plan's job count does not
grow with the number of rules while a rule-at-a-time loop's does.

Before timing, the flagship workload runs once, untimed, on the smallest test
data (sf0.001) so that one-time JVM class loading and code generation are not
charged to whichever workload happens to run first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tessera.clock import RunClock  # noqa: E402
from tessera.functions.local import local_frame  # noqa: E402
from tessera.operators import profile as PR  # noqa: E402
from tessera.operators.spec import Mapping  # noqa: E402
from tessera.plans import suite  # noqa: E402
from tessera.plans.engine import ObjectRun, validate  # noqa: E402
from tessera.session import build_session, checkpoint_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
CLOCK = RunClock.fixed("2024-06-01 00:00:00")

LINEITEM_RULES = [  # (column, logic): twelve row-local rules on one object
    ("l_quantity", '{"min": 1, "max": 50}'),
    ("l_extendedprice", '{"max": 100000}'),
    ("l_discount", '{"min": 0, "max": 0.1}'),
    ("l_tax", '{"max": 0.08}'),
    ("l_returnflag", '{"allowed": ["A", "N", "R"]}'),
    ("l_linestatus", '{"allowed": ["O", "F"], "is_nullable": "NO"}'),
    ("l_shipdate", '{"min_date": "1992-01-01", "max_date": "1998-12-31"}'),
    ("l_orderkey", '{"is_nullable": "NO"}'),
    ("l_returnflag", '{"regex": "^[ANR]$"}'),
    ("l_linenumber", '{"min": 1, "max": 7}'),
    ("l_partkey", '{"min": 1}'),
    ("l_suppkey", '{"forbidden": [0]}'),
]


WARMUP_DIR = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")


def table(spark: SparkSession, name: str, sf_dir: str | None = None) -> DataFrame:
    return spark.read.parquet(f"{sf_dir or SF_DIR}/{name}.parquet")


def mappings(rules, object_name, pk, start=1):
    return [Mapping(start + i, start + i, 7, col, logic, "Custodial", "", object_name, pk)
            for i, (col, logic) in enumerate(rules)]


def lineitem_run(spark, rules, extra=(), tables=None, thresholds=None):
    ms = mappings(rules, "lineitem", "l_orderkey, l_linenumber") + list(extra)
    return validate(spark, ObjectRun(7, "lineitem", "l_orderkey, l_linenumber", table(spark, "lineitem"), ms,
                                     CLOCK, tables=tables or {}, thresholds=thresholds))


def run_noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def fused_rules(spark):
    run_noop(lineitem_run(spark, LINEITEM_RULES).detailed)


def rule_at_a_time(spark):
    """The same twelve rules the way a per-rule loop runs them: per rule a count of
    the source, an emptiness probe and a failure count (three actions per rule)."""
    for m in mappings(LINEITEM_RULES, "lineitem", "l_orderkey, l_linenumber"):
        r = validate(spark, ObjectRun(7, "lineitem", "l_orderkey, l_linenumber", table(spark, "lineitem"), [m], CLOCK))
        table(spark, "lineitem").count()
        r.detailed.head(1)
        r.detailed.count()


def fused_rules_200(spark):
    """Rule-count scaling: 200 rarely failing bounds on seven lineitem columns."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]
    rules = [(cols[i % len(cols)], '{"max": %d}' % (100000 - i)) for i in range(1, 201)]
    run_noop(lineitem_run(spark, rules).detailed)


def summary_with_tiers(spark):
    th = local_frame(spark, [(i, i, 0.01, 1, 1) for i in range(1, 13)] + [(100 + i, i, 0.05, 2, 1) for i in range(1, 13)],
                               "Threshold_ID int, Mapping_ID int, Failure_Threshold_Value double, "
                               "Criticality int, Active int")
    run_noop(lineitem_run(spark, LINEITEM_RULES, thresholds=th).aggregated)


def duplicate_keys(spark):
    ms = [Mapping(50, 2, 7, "l_orderkey, l_linenumber", '{"distinct": true}', "Custodial", "", "lineitem",
                  "l_orderkey, l_partkey, l_suppkey")]
    r = validate(spark, ObjectRun(7, "lineitem", "l_orderkey, l_partkey, l_suppkey", table(spark, "lineitem"), ms, CLOCK))
    run_noop(r.detailed)


def lookups(spark):
    tables = {"tpch.part": table(spark, "part"), "tpch.supplier": table(spark, "supplier")}
    extra = [Mapping(60, 17, 7, "l_partkey", '{"allowed": {"dataset_id": "tpch", "table_name": "part", '
                     '"column_name": "p_partkey"}}', "Custodial", "", "lineitem", "l_orderkey, l_linenumber"),
             Mapping(61, 17, 7, "l_suppkey", '{"allowed": {"dataset_id": "tpch", "table_name": "supplier", '
                     '"column_name": "s_suppkey"}}', "Custodial", "", "lineitem", "l_orderkey, l_linenumber")]
    run_noop(lineitem_run(spark, [], extra=extra, tables=tables).detailed)


def business_reconcile(spark):
    table(spark, "orders").createOrReplaceTempView("tpch_orders")
    table(spark, "lineitem").createOrReplaceTempView("tpch_lineitem")
    ms = [Mapping(70, 16, 2, "total_cents, n_lines", suite.BILLED_SQL, "Business", "", "orders", "o_orderkey")]
    run_noop(validate(spark, ObjectRun(2, "orders", "o_orderkey", table(spark, "orders"), ms, CLOCK)).detailed)


def text_uniqueness(spark):
    ms = [Mapping(80, 2, 6, "text", '{"distinct": true}', "Custodial", "", "documents", "doc_id"),
          Mapping(81, 10, 6, "text", '{"max_length": 20000, "min_length": 1}', "Custodial", "", "documents", "doc_id")]
    run_noop(validate(spark, ObjectRun(6, "documents", "doc_id", table(spark, "documents"), ms, CLOCK)).detailed)


def profile_lineitem(spark):
    run_noop(PR.profile(table(spark, "lineitem")))


WORKLOADS = {
    "fused_rules_12": fused_rules,
    "summary_with_tiers": summary_with_tiers,
    "duplicate_keys": duplicate_keys,
    "lookups": lookups,
    "business_reconcile": business_reconcile,
    "text_uniqueness": text_uniqueness,
    "profile_lineitem": profile_lineitem,
}


def main() -> None:
    spark = build_session(f"local[{CPUS}]", int(CPUS) * 2,
                          extra={"spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    checkpoint_dir(spark)
    sc = spark.sparkContext
    if os.path.isdir(WARMUP_DIR):
        ms = mappings(LINEITEM_RULES, "lineitem", "l_orderkey, l_linenumber")
        warm = validate(spark, ObjectRun(7, "lineitem", "l_orderkey, l_linenumber",
                                         table(spark, "lineitem", WARMUP_DIR), ms, CLOCK))
        run_noop(warm.detailed)
        run_noop(warm.aggregated)
    times, jobs = {}, {}
    extras = [("rule_at_a_time_12", rule_at_a_time), ("fused_rules_200", fused_rules_200)]
    for name, fn in list(WORKLOADS.items()) + extras:
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        fn(spark)
        times[name] = round(time.perf_counter() - t0, 3)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(name))
    headline = {k: v for k, v in times.items() if k in WORKLOADS}
    print(json.dumps({
        "metric": "validation_workloads_total",
        "value": round(sum(headline.values()), 3),
        "unit": "sec",
        "queries": times,
        "spark_jobs": jobs,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
