"""Bindings of mechanisms that go beyond one rule at a time, on the test tables, and their SQL twins."""

from __future__ import annotations

import datetime as dt
import uuid
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.local import local_frame
from tessera.operators import discovery
from tessera.operators import history
from tessera.operators import profile as PR
from tessera.operators.spec import Mapping
from tessera.plans.engine import ObjectRun, validate
from tessera.plans.suite import CLOCK, OBJECT_IDS, run_rules, table
from tessera.session import checkpoint_dir
from tessera.sources import readers
from tessera.sources.readers import windowed

LINE_KEY = "l_orderkey, l_linenumber"

# ---- threshold ladders (P3-P8): (first Mapping_ID, column, test key, bounds) ---------------

PRICE_CAPS = list(range(92_500, 105_000, 250))
LADDERS = [
    (3000, "l_extendedprice", "max", PRICE_CAPS),
    (3100, "l_quantity", "min", [1, 2, 2, 3, 4, 5]),
    (3200, "l_discount", "max", [0.055, 0.065, 0.075, 0.085, 0.095, 0.1]),
    (3300, "l_shipdate", "max_date", [f"2001-{m:02d}-15" for m in range(5, 11)]),
    (3400, "l_shipdate", "min_date", [f"1995-01-{d:02d} 06:00:00" for d in range(4, 20, 3)]),
    (3500, "l_tax", "max", [0.08]),
]
PART_LADDERS = [
    (3600, "p_name", "max_length", [9, 10, 10, 11, 12]),
    (3700, "p_name", "min_length", [8, 9, 10, 11]),
    (3800, "p_brand", "max", ["Brand#20", "Brand#3", "Brand#4", "Brand#9"]),
    (3900, "p_size", "max", [48, 45, 49, 45.5, 46.5, 47.5, 48.5, 40]),
]


def _ladder_rules(ladders) -> list[tuple]:
    quoted = lambda b: f'"{b}"' if isinstance(b, str) else str(b)
    return [(first + i, 7, column, f'{{"{key}": {quoted(bound)}}}', "") for first, column, key, bounds in ladders
            for i, bound in enumerate(bounds)]


def _ladder_run(spark: SparkSession, sf_dir: str, name: str, pk: str, ladders):
    return run_rules(spark, table(spark, sf_dir, name), name, pk, _ladder_rules(ladders))


def ladder_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighty bounds on five columns of lineitem: one scan, a comparison and a binary search per column and direction."""
    return _ladder_run(spark, sf_dir, "lineitem", LINE_KEY, LADDERS).report()


def ladder_bounds_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ladder_run(spark, sf_dir, "part", "p_partkey", PART_LADDERS).report()


def ladder_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bounds' counts, from one histogram aggregate."""
    return _ladder_run(spark, sf_dir, "lineitem", LINE_KEY, LADDERS).counts.select("Mapping_ID", "Failure_Count", "Row_Count")


def _fails_sql(column: str, key: str, bound) -> str:
    if key in ("min_length", "max_length"):
        return f"length({column}) {'<' if key == 'min_length' else '>'} {bound}"
    if key in ("min_date", "max_date"):
        target = f"TIMESTAMP '{bound}'" if " " in bound else f"DATE '{bound}'"
        return f"{column if ' ' in bound else f'CAST({column} AS DATE)'} {'<' if key == 'min_date' else '>'} {target}"
    return f"{column} {'<' if key == 'min' else '>'} " + (f"'{bound}'" if isinstance(bound, str) else f"CAST({bound} AS DOUBLE)")


def _ladder_sql(name: str, pk_cols: list[str], ladders) -> str:
    key = " || ', ' || ".join(f"CAST({c} AS VARCHAR)" for c in pk_cols)
    return "\nUNION ALL\n".join(
        f"SELECT {first + i}::INT AS Mapping_ID, 7::INT AS Rule_ID, {OBJECT_IDS[name]}::INT AS Object_ID, 1::INT AS Run_ID, "
        f"'{column}' AS Column_Name, '{', '.join(pk_cols)}' AS Primary_Key_Column_s_, {key} AS Primary_Key_Value_s_, "
        f"CAST({column} AS VARCHAR) AS Actual_Value FROM {name} WHERE {_fails_sql(column, test, bound)}"
        for first, column, test, bounds in ladders for i, bound in enumerate(bounds))


def _ladder_counts_sql(name: str, ladders) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {first + i}::INT AS Mapping_ID, count(*) FILTER ({_fails_sql(column, test, bound)}) AS Failure_Count, "
        f"count(*) AS Row_Count FROM {name}" for first, column, test, bounds in ladders for i, bound in enumerate(bounds))


# ---- mergeable profiles (F1-F9, F4 sketched, F5) ------------------------------------------

# Columns of lineitem whose distinct values stay few at any scale: sketches are exact for them.
PROFILED = ["l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
YEARS = [dt.datetime(1990, 1, 1), dt.datetime(1996, 7, 1), dt.datetime(1999, 1, 1), dt.datetime(2100, 1, 1)]


def profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three windows profiled apart, their states added up: the profile of all rows."""
    lines = table(spark, sf_dir, "lineitem").select(*PROFILED)
    states = [PR.profile_state(windowed(lines, "l_shipdate", a, b)) for a, b in zip(YEARS, YEARS[1:])]
    return PR.profile_of(PR.merge_states(states), lines).select(
        "column_name", "row_count", "null_count", "distinct_count", "min_value", "max_value", "min_length", "max_length",
        F.array_join("sample_values", "|").alias("samples"))


def _profile_merged_sql() -> str:
    number = {"l_linenumber", "l_quantity", "l_discount", "l_tax"}
    text = {"l_returnflag", "l_linestatus"}
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
        + (f"min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, " if c in number else "NULL::DOUBLE AS min_value, NULL::DOUBLE AS max_value, ")
        + (f"min(length({c}))::INT AS min_length, max(length({c}))::INT AS max_length, " if c in text else "NULL::INT AS min_length, NULL::INT AS max_length, ")
        + f"(SELECT string_agg(v::VARCHAR, '|' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM lineitem WHERE {c} IS NOT NULL ORDER BY v LIMIT 5) x) "
          "AS samples FROM lineitem" for c in PROFILED)


# ---- proposals beyond a column's bounds (F11 with A2, P10, P2) -----------------------------

KEYED = {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"],
         "conversations": ["conv_id", "turn", "role"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus"]}


def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [(name, ", ".join(key)) for name, columns in KEYED.items()
             for key in discovery.composite_keys(table(spark, sf_dir, name), 3, columns)]
    return local_frame(spark, found, "table_name string, key_columns string")


def _composite_keys_sql() -> str:
    parts = []
    for name, columns in KEYED.items():
        combos = [c for size in (1, 2, 3) for c in combinations(columns, size)]
        unique = ", ".join(f"count(DISTINCT ({', '.join(c)},)) = count(*) AS u{i}" for i, c in enumerate(combos))
        for i, c in enumerate(combos):
            smaller = " ".join(f"AND NOT u{j}" for j, d in enumerate(combos) if set(d) < set(c))
            parts.append(f"SELECT '{name}' AS table_name, '{', '.join(c)}' AS key_columns FROM (SELECT {unique} FROM {name}) WHERE u{i} {smaller}")
    return "\nUNION ALL\n".join(parts)


# Whole-number columns looked up, and the key columns of other tables that may hold them all.
LOOKED_UP = {"region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey"],
             "supplier": ["s_suppkey", "s_nationkey"], "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_suppkey"],
             "labels": ["doc_id"], "documents": ["doc_id"]}


def lookup_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name).select(*columns) for name, columns in LOOKED_UP.items()}
    return discovery.lookup_rules(spark, tables).select("table_name", "column_name", "lookup_table", "lookup_column")


def _lookup_proposals_sql() -> str:
    columns = [(t, c) for t, cs in LOOKED_UP.items() for c in cs]
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{u}' AS lookup_table, '{d}' AS lookup_column "
        f"WHERE (SELECT count(DISTINCT {d}) = count(*) FROM {u}) AND (SELECT count(DISTINCT {c}) >= 2 FROM {t}) "
        f"AND NOT EXISTS (SELECT 1 FROM {t} a WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {d} FROM {u}))"
        for t, c in columns for u, d in columns if t != u)


PATTERNED = {"part": ["p_brand", "p_type", "p_name"], "customer": ["c_name", "c_mktsegment"], "orders": ["o_orderpriority", "o_orderstatus"]}


def pattern_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = None
    for name, columns in PATTERNED.items():
        one = discovery.patterns(table(spark, sf_dir, name), columns)
        found = one if found is None else found.unionByName(one)
    return found


def _pattern_proposals_sql() -> str:
    texts = "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, {c} AS value FROM {t} WHERE {c} IS NOT NULL" for t, cs in PATTERNED.items() for c in cs)
    return rf"""
        WITH texts AS ({texts}),
        masked AS (
          SELECT column_name, regexp_replace(regexp_replace(regexp_replace(value, '[0-9]+', '9', 'g'), '[A-Z]+', 'A', 'g'), '[a-z]+', 'a', 'g') AS mask,
                 regexp_extract_all(value, '[0-9]+|[A-Z]+|[a-z]+|[^0-9A-Za-z]') AS runs FROM texts),
        cut AS (SELECT column_name, mask, unnest(runs) AS run, unnest(range(1, len(runs) + 1)) AS place FROM masked),
        bounds AS (SELECT column_name, mask, place, min(run) AS run, min(length(run)) AS least, max(length(run)) AS most FROM cut GROUP BY ALL),
        pieces AS (
          SELECT column_name, mask, place, CASE WHEN regexp_matches(run, '^[0-9A-Za-z]') THEN
                   CASE WHEN regexp_matches(run, '^[0-9]') THEN '[0-9]' WHEN regexp_matches(run, '^[A-Z]') THEN '[A-Z]' ELSE '[a-z]' END
                   || CASE WHEN least = 1 AND most = 1 THEN '' WHEN least = most THEN '{{' || least || '}}' ELSE '{{' || least || ',' || most || '}}' END
                 WHEN run = ' ' THEN run ELSE chr(92) || run END AS piece FROM bounds),
        joined AS (SELECT column_name, mask, string_agg(piece, '' ORDER BY place) AS body FROM pieces GROUP BY ALL),
        listed AS (SELECT column_name, count(*) AS n, string_agg(body, '|' ORDER BY mask) AS bodies FROM joined GROUP BY column_name)
        SELECT column_name, CASE WHEN n = 1 THEN '^' || bodies || '$' ELSE '^(' || bodies || ')$' END AS regex FROM listed WHERE n <= 4"""


# ---- uniqueness against history (A1 over windows) -------------------------------------------

HOURS = [dt.datetime(2024, 1, 15, h) for h in (10, 11, 12, 13)]


def distinct_over_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per user, ever: three hourly windows judged in turn, the last one's failures. The first two are known by
    their keys alone."""
    known = history.KeyHistory(spark, f"{checkpoint_dir(spark).rstrip('/')}/tessera-keys/{uuid.uuid4().hex}", 8)
    events = table(spark, sf_dir, "events")
    for start, end in zip(HOURS[:2], HOURS[1:3]):
        known.remember(windowed(events, "ts", start, end), ["user_id"], start)
    last = windowed(events, "ts", HOURS[2], HOURS[3])
    return history.uniqueness_failures(last, ["user_id"], ["event_id"], known, HOURS[2])


_DISTINCT_OVER_WINDOWS_SQL = """
    WITH last AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00' AND ts < TIMESTAMP '2024-01-15 13:00:00' AND user_id IS NOT NULL),
    judged AS (
      SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) > 1 AS inside,
             user_id IN (SELECT user_id FROM events WHERE user_id IS NOT NULL
                         AND ts >= TIMESTAMP '2024-01-15 10:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00') AS before FROM last)
    SELECT event_id::VARCHAR AS Primary_Key_Value_s_, user_id::VARCHAR AS Actual_Value,
           CASE WHEN inside AND before THEN 'window, history' WHEN inside THEN 'window' ELSE 'history' END AS Repeats
    FROM judged WHERE inside OR before"""


# ---- malformed records (S5, S7) --------------------------------------------------------------

LINES = "o_orderkey bigint, o_totalprice double, o_orderpriority string"


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV and JSON lines, some of them broken: findings for these, the rule's failures among the others."""
    orders = table(spark, sf_dir, "orders")
    few, wrong = F.col("o_orderkey") % 50 == 0, F.col("o_orderkey") % 50 == 1
    price = F.when(wrong, F.lit("dear")).otherwise(F.col("o_totalprice").cast("string"))
    comma = F.when(few, F.concat_ws(",", "o_orderkey", F.lit("1"))).otherwise(F.concat_ws(",", "o_orderkey", price, "o_orderpriority"))
    json = F.when(few, F.concat(F.lit('{"o_orderkey": '), "o_orderkey")).otherwise(
        F.to_json(F.struct("o_orderkey", F.when(~wrong, F.col("o_totalprice")).alias("o_totalprice"), "o_orderpriority")))
    schema = spark.createDataFrame([], LINES).schema
    out = None
    for extension, lines in (("csv", comma), ("json", json)):
        path = f"{checkpoint_dir(spark).rstrip('/')}/tessera-lines/{uuid.uuid4().hex}"
        orders.select(lines.alias("value")).write.text(path)
        rows, findings = readers.read_with_findings(spark, path, extension, schema, 2)
        failures = run_rules(spark, rows, "orders", "o_orderkey", [(401, 8, "o_totalprice", '{"max": 400000}', "")]).failures
        told = F.sum(F.regexp_extract("Detail", r": (\d+) record", 1).cast("long"))
        counts = (findings.agg(F.lit(f"{extension} malformed").alias("what"), F.coalesce(told, F.lit(0)).alias("n"))
                  .unionByName(failures.agg(F.lit(f"{extension} failing").alias("what"), F.count(F.lit(1)).alias("n")))
                  .unionByName(rows.agg(F.lit(f"{extension} rows").alias("what"), F.count(F.lit(1)).alias("n"))))
        out = counts if out is None else out.unionByName(counts)
    return out


_MALFORMED_LINES_SQL = """
    SELECT 'csv malformed' AS what, count(*) FILTER (o_orderkey % 50 < 2) AS n FROM orders
    UNION ALL SELECT 'csv failing', count(*) FILTER (o_orderkey % 50 >= 2 AND o_totalprice > 400000) FROM orders
    UNION ALL SELECT 'csv rows', count(*) FILTER (o_orderkey % 50 >= 2) FROM orders
    UNION ALL SELECT 'json malformed', count(*) FILTER (o_orderkey % 50 = 0) FROM orders
    UNION ALL SELECT 'json failing', count(*) FILTER (o_orderkey % 50 >= 2 AND o_totalprice > 400000) FROM orders
    UNION ALL SELECT 'json rows', count(*) FILTER (o_orderkey % 50 > 0) FROM orders"""


# ---- nested types (P15, S9) ------------------------------------------------------------------

NESTED = [("info", "STRUCT<o_custkey INT64, price STRUCT<o_totalprice DATE, keys ARRAY<BOOL>, o_orderpriority STRING>, lost STRING>", "YES")]


def type_check_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong and missing parts one, two and three levels below a column."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "struct(o_custkey, struct(o_totalprice, array(o_custkey) AS keys, o_orderpriority) AS price) AS info")
    m = Mapping(410, 13, 2, "", "{}", "Custodial", "types", "orders", "o_orderkey")
    return validate(spark, ObjectRun(2, "orders", "o_orderkey", orders, [m], CLOCK, declared=NESTED)).detailed.select(
        "Mapping_ID", "Primary_Key_Value_s_", "Actual_Value")


_TYPE_CHECK_NESTED_SQL = """
    WITH kinds AS (SELECT max(typeof(o_totalprice)) AS price, max(typeof(o_custkey)) AS id FROM orders),
    parts(path, kind, declared) AS (
      SELECT 'info.price.o_totalprice', price, 'DATE' FROM kinds UNION ALL SELECT 'info.price.keys[]', id, 'BOOL' FROM kinds
      UNION ALL SELECT 'info.lost', NULL, 'STRING' FROM kinds)
    SELECT 410::INT AS Mapping_ID, path AS Actual_Value, path || CASE WHEN kind IS NULL THEN ' is missing.'
             ELSE ' detected as ' || lower(kind) || ' type.' END || ' Schema specifies ' || declared || ' type.' AS Primary_Key_Value_s_
    FROM parts"""


QUERIES = {
    "type_check_nested": type_check_nested,
    "malformed_lines": malformed_lines,
    "distinct_over_windows": distinct_over_windows,
    "composite_keys": composite_keys,
    "lookup_proposals": lookup_proposals,
    "pattern_proposals": pattern_proposals,
    "ladder_bounds": ladder_bounds,
    "ladder_bounds_text": ladder_bounds_text,
    "ladder_counts": ladder_counts,
    "profile_merged": profile_merged,
}
ORACLE_SQL = {
    "type_check_nested": _TYPE_CHECK_NESTED_SQL,
    "malformed_lines": _MALFORMED_LINES_SQL,
    "distinct_over_windows": _DISTINCT_OVER_WINDOWS_SQL,
    "composite_keys": _composite_keys_sql(),
    "lookup_proposals": _lookup_proposals_sql(),
    "pattern_proposals": _pattern_proposals_sql(),
    "ladder_bounds": _ladder_sql("lineitem", ["l_orderkey", "l_linenumber"], LADDERS),
    "ladder_bounds_text": _ladder_sql("part", ["p_partkey"], PART_LADDERS),
    "ladder_counts": _ladder_counts_sql("lineitem", LADDERS),
    "profile_merged": _profile_merged_sql(),
}
