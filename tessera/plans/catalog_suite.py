"""Bindings of a whole catalog run: plan, windows, rules, results and states over the test tables.

Two consecutive runs over orders and customer (whole tables), lineitem (daily window on a
date) and events (hourly window), with objects and participating tables loaded by name. The
runs write to a fresh folder of the shared checkpoint folder; the bindings read the results.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.clock import RunClock
from tessera.plans import runner
from tessera.plans.catalog import Catalog
from tessera.session import checkpoint_dir
from tessera.sources.readers import folder_tables

FIRST, SECOND = dt.datetime(2024, 1, 15, 12, 0), dt.datetime(2024, 1, 15, 13, 0)
SHIPPED_LATE = """SELECT o_orderkey, o_orderpriority FROM `shop.sales.orders`
  WHERE o_orderpriority = '1-URGENT' AND EXISTS (
    SELECT 1 FROM `shop.sales.lineitem` WHERE l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 120 DAYS)"""

RULES = [(1, "key present", '{"is_nullable": "NO"}', "Custodial"), (2, "price cap", '{"max": 400000}', "Custodial"),
         (3, "urgent but late", SHIPPED_LATE, "Business"), (4, "no debt", '{"min": -500}', "Custodial"),
         (5, "one buyer per order", '{"distinct": true}', "Custodial"), (6, "not an error", '{"forbidden": ["error"]}', "Custodial"),
         (7, "one event per user", '{"distinct": true}', "Custodial")]
OBJECTS = [(1, "orders", "sales", None, "o_orderkey", "full table", None, "daily", 1),
           (2, "customer", "sales", None, "c_custkey", "full table", None, "daily", 1),
           (3, "events", "sales", None, "event_id", "daily", 60, "hourly", 1),
           (4, "part", "sales", None, "p_partkey", "full table", None, "daily", 0)]   # not active
MAPPINGS = [(11, 1, 1, "o_custkey", None, None, "Custodial", 1), (12, 1, 2, "o_totalprice", None, None, "Custodial", 1),
            (13, 1, 3, "o_orderkey, o_orderpriority", "sales.orders,sales.lineitem", None, "Business", 1),
            (14, 2, 4, "c_acctbal", None, None, "Custodial", 1), (15, 1, 5, "o_custkey", None, None, "Custodial", 1),
            (16, 3, 6, "event_type", None, "ts", "Custodial", 1), (17, 3, 7, "user_id", None, "ts", "Custodial", 1),
            (18, 2, 1, "c_name", None, None, "Custodial", 0), (19, 2, 1, "c_name", None, None, "Custodial", 1)]  # 18 not active
THRESHOLDS = [(1, 11, 0.0, 3, 1), (2, 12, 0.01, 1, 1), (3, 12, 0.05, 2, 1), (4, 13, 0.0, 2, 1), (5, 14, 0.02, 1, 1),
              (6, 15, 0.5, 3, 1), (7, 16, 0.1, 1, 1), (8, 16, 0.2, 2, 1), (9, 17, 0.0, 1, 1), (10, 18, 0.0, 1, 1)]  # 19 has none
HANDLERS = [(1, "look at it"), (2, "act on it")]
CONTACTS = [(1, "team@data.invalid"), (2, "owner@data.invalid")]
NOTIFICATIONS = [(1, 1, 1), (2, 2, 2)]
ROUTES = [(1, 1, 1, 1), (2, 1, 2, 2), (3, 1, 2, 3), (4, 3, 1, 1), (5, 3, 2, 2)]


def catalog(spark: SparkSession) -> Catalog:
    return Catalog.from_rows(spark, rule=RULES, object_lookup=OBJECTS, rule_mapping=MAPPINGS, rule_threshold=THRESHOLDS,
                             handler=HANDLERS, distribution=CONTACTS, notification=NOTIFICATIONS, object_notification=ROUTES)


def two_runs(spark: SparkSession, sf_dir: str) -> str:
    """Run the catalog at noon and an hour later; the folder with both runs' results."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/tessera-runs/{uuid.uuid4().hex}"
    load = folder_tables(spark, sf_dir)
    runner.run(spark, catalog(spark), lambda p: load(p.object_name), out, clock=RunClock(FIRST), load_table=load,
               database="sales")
    history = runner.read_result(spark, out, "execution")
    log = runner.read_result(spark, out, "object_log")
    runner.run(spark, catalog(spark), lambda p: load(p.object_name), out, clock=RunClock(SECOND), load_table=load,
               database="sales", execution=history, object_log=log, history_in_place=True)
    return out


def catalog_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.read_result(spark, two_runs(spark, sf_dir), "detailed").select(
        "Mapping_ID", "Rule_ID", "Object_ID", "Run_ID", "Primary_Key_Value_s_", "Actual_Value")


def catalog_aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.read_result(spark, two_runs(spark, sf_dir), "aggregated").select(
        "Mapping_ID", "Rule_ID", "Object_ID", "Run_ID", "Failure_Count", "Failure_Percent", "Criticality")


def catalog_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.read_result(spark, two_runs(spark, sf_dir), "execution").select(
        "Object_ID", "Run_Id", "Val_Status", "Curr_Val_St_Dt", "Curr_Val_End_Dt", "Next_Val_St_Dt", "Next_Val_End_Dt")


def catalog_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.read_result(spark, two_runs(spark, sf_dir), "alerts").select(
        "Rule_ID", "Object_ID", "Run_ID", "Criticality", "Column_Name", "Notification_Handler_Text")


def fixed_and_rerun(spark: SparkSession, sf_dir: str) -> str:
    """Orders and customer validated, then again as the same object run after customer was put right."""
    out = f"{checkpoint_dir(spark).rstrip('/')}/tessera-runs/{uuid.uuid4().hex}"
    load = folder_tables(spark, sf_dir)

    def fixed(plan):
        rows = load(plan.object_name)
        return rows.where("c_acctbal >= -500") if plan.object_name == "customer" else rows

    for clock, loader in ((FIRST, lambda p: load(p.object_name)), (SECOND, fixed)):
        runner.run(spark, catalog(spark), loader, out, clock=RunClock(clock), load_table=load, object_ids=[1, 2])
    return out


def catalog_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun replaces what the first attempt found, also where it finds nothing."""
    return runner.read_result(spark, fixed_and_rerun(spark, sf_dir), "detailed").select(
        "Mapping_ID", "Rule_ID", "Object_ID", "Run_ID", "Primary_Key_Value_s_", "Actual_Value")


def catalog_rerun_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runner.read_result(spark, fixed_and_rerun(spark, sf_dir), "aggregated").select(
        "Mapping_ID", "Object_ID", "Run_ID", "Failure_Count")


QUERIES = {"catalog_rerun": catalog_rerun, "catalog_rerun_counts": catalog_rerun_counts, "catalog_detailed": catalog_detailed, "catalog_aggregated": catalog_aggregated,
           "catalog_states": catalog_states, "catalog_alerts": catalog_alerts}


def _text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _failures(run: int) -> str:
    """Failing rows of one run, as (Mapping_ID, Rule_ID, Object_ID, Run_ID, key, value)."""
    day = "2024-01-15"
    hour = (f"ts >= TIMESTAMP '{day} {10 + run}:00:00' AND ts < TIMESTAMP '{day} {11 + run}:00:00'")
    events = f"(SELECT * FROM events WHERE {hour})"
    parts = [
        (11, 1, 1, "o_orderkey", _text("o_custkey"), "orders WHERE o_custkey IS NULL"),
        (12, 2, 1, "o_orderkey", _text("o_totalprice"), "orders WHERE o_totalprice > 400000"),
        (13, 3, 1, "o_orderkey", f"{_text('o_orderkey')} || ', ' || o_orderpriority",
         "orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN orders "
         "ON l_orderkey = o_orderkey WHERE date_diff('second', o_orderdate, l_shipdate) > 120 * 86400)"),
        (14, 4, 2, "c_custkey", _text("c_acctbal"), "customer WHERE c_acctbal < -500"),
        (15, 5, 1, "o_orderkey", _text("o_custkey"),
         "(SELECT *, count(*) OVER (PARTITION BY o_custkey) AS same FROM orders WHERE o_custkey IS NOT NULL) q WHERE same > 1"),
        (16, 6, 3, "event_id", "event_type", f"{events} q WHERE event_type = 'error'"),
        (17, 7, 3, "event_id", _text("user_id"),
         f"(SELECT *, count(*) OVER (PARTITION BY user_id) AS same FROM {events} e WHERE user_id IS NOT NULL) q WHERE same > 1"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT {m}::INTEGER AS Mapping_ID, {r}::INTEGER AS Rule_ID, {o}::INTEGER AS Object_ID, {run}::INTEGER AS Run_ID, "
        f"{_text(key)} AS Primary_Key_Value_s_, {value} AS Actual_Value FROM {rows}" for m, r, o, key, value, rows in parts)


def _both(sql) -> str:
    return f"{sql(1)}\nUNION ALL\n{sql(2)}"


def _aggregated_sql() -> str:
    meta = ", ".join(f"({m}, {r}, {o})" for m, o, r, *_ in MAPPINGS if m not in (18, 19))
    tiers = ", ".join(f"({m}, {v}, {c})" for _, m, v, c, _ in THRESHOLDS)
    rows = "\nUNION ALL\n".join(
        f"SELECT {run} AS run, 1 AS oid, count(*) AS n FROM orders UNION ALL SELECT {run}, 2, count(*) FROM customer UNION ALL "
        f"SELECT {run}, 3, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-15 {10 + run}:00:00' "
        f"AND ts < TIMESTAMP '2024-01-15 {11 + run}:00:00'" for run in (1, 2))
    return f"""
        WITH failing AS ({_both(_failures)}), rows AS ({rows}), meta(mid, rid, oid) AS (VALUES {meta}),
        tiers(mid, least, tier) AS (VALUES {tiers}),
        counted AS (
          SELECT mid, rid, meta.oid, run, n, (SELECT count(*) FROM failing WHERE Mapping_ID = mid AND Run_ID = run) AS k
          FROM meta JOIN rows ON meta.oid = rows.oid),
        rated AS (SELECT *, CASE WHEN n > 0 AND k > 0 THEN k::DOUBLE / n ELSE 0.0 END AS rate FROM counted)
        SELECT mid::INTEGER AS Mapping_ID, rid::INTEGER AS Rule_ID, oid::INTEGER AS Object_ID, run::INTEGER AS Run_ID,
               k::BIGINT AS Failure_Count, rate::DOUBLE AS Failure_Percent,
               (SELECT tier FROM tiers WHERE tiers.mid = rated.mid AND k > 0 AND least <= rate
                ORDER BY least DESC, tier DESC LIMIT 1)::INTEGER AS Criticality
        FROM rated"""


def _alerts_sql() -> str:
    routes = ", ".join(f"({o}, {n}, {c})" for _, o, n, c in ROUTES)
    texts = ", ".join(f"({n}, '{dict(HANDLERS)[h]}')" for n, _, h in NOTIFICATIONS)
    names = ", ".join(f"({m}, '{column}')" for m, _, _, column, *_ in MAPPINGS)
    return f"""
        WITH agg AS ({_aggregated_sql()}), routes(oid, nid, tier) AS (VALUES {routes}), texts(nid, txt) AS (VALUES {texts}),
        names(mid, col) AS (VALUES {names})
        SELECT Rule_ID, Object_ID, Run_ID, Criticality, col AS Column_Name, txt AS Notification_Handler_Text
        FROM agg JOIN names ON mid = Mapping_ID LEFT JOIN (routes JOIN texts USING (nid)) ON oid = Object_ID AND tier = Criticality
        WHERE Criticality IS NOT NULL"""


def _states_sql() -> str:
    """Per object and run an opened and a closed row; read off the given tables' objects."""
    runs = []
    for run, now in ((1, FIRST), (2, SECOND)):
        for oid, name in ((1, "orders"), (2, "customer"), (3, "events")):
            start, end = (now - dt.timedelta(hours=1), now) if oid == 3 else (dt.datetime(1900, 1, 1), now)
            later = (now, now + dt.timedelta(hours=1)) if oid == 3 else (dt.datetime(1900, 1, 1), now + dt.timedelta(days=1))
            for status in ("Executing", "Success"):
                stamps = ", ".join(f"TIMESTAMP '{x}'" for x in (start, end, *later))
                runs.append(f"SELECT {oid}::INTEGER, {run}::INTEGER, '{status}', {stamps} "
                            f"WHERE (SELECT count(*) FROM {name}) > 0")
    union = "\nUNION ALL\n".join(runs)
    return (f"SELECT * FROM ({union}) s(Object_ID, Run_Id, Val_Status, Curr_Val_St_Dt, Curr_Val_End_Dt, Next_Val_St_Dt, Next_Val_End_Dt)")


def _rerun_sql() -> str:
    return f"SELECT * FROM ({_failures(1)}) f WHERE Object_ID = 1"


ORACLE_SQL = {"catalog_rerun": _rerun_sql(),
              "catalog_rerun_counts": f"""
        SELECT m::INTEGER AS Mapping_ID, o::INTEGER AS Object_ID, 1::INTEGER AS Run_ID,
               (SELECT count(*) FROM ({_rerun_sql()}) f WHERE Mapping_ID = m) AS Failure_Count
        FROM (VALUES {', '.join(f'({m}, {o})' for m, o, *_ in MAPPINGS if o in (1, 2) and m < 18)}) v(m, o)""",
              "catalog_detailed": _both(_failures), "catalog_aggregated": _aggregated_sql(), "catalog_states": _states_sql(),
              "catalog_alerts": _alerts_sql()}
