"""Rule bindings on the test tables: one Spark query per operator, and its SQL twin.

Each query validates a whole test table (or a join of test tables) with the
engine and returns the stable report columns of the detailed table, or the
aggregate rows. The SQL twin computes the same rows independently in plain SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.clock import RunClock
from tessera.functions.local import local_frame
from tessera.operators.spec import Mapping
from tessera.plans.engine import ObjectRun, ValidationResult, passing_rows, validate

CLOCK = RunClock.fixed("2024-06-01 00:00:00")

# Object ids of the test tables in these bindings.
OBJECT_IDS = {"customer": 1, "orders": 2, "part": 3, "pages": 4, "events": 5, "documents": 6,
              "lineitem": 7, "conversations": 8}

# Thresholds of the summary binding, in the seed's 1/5/10 % ladder style:
# (Threshold_ID, Mapping_ID, Failure_Threshold_Value, Criticality, Active).
LADDER = [(1, 101, 0.01, 1, 1), (2, 101, 0.05, 2, 1), (3, 101, 0.10, 3, 1),
          (4, 102, 0.01, 1, 1), (5, 102, 0.05, 2, 1), (6, 102, 0.10, 3, 1),
          (7, 103, 0.0, 2, 1),
          (8, 104, 0.005, 1, 1), (9, 104, 0.01, 2, 1), (10, 104, 0.05, 3, 1),
          (11, 105, 0.2, 3, 0)]

MIN_SLICE = [  # (Mapping_ID, Rule_ID, column, logic, description)
    (101, 8, "o_totalprice", '{"max": 450000}', "Total price must not exceed 450000"),
    (102, 5, "o_orderpriority", '{"allowed": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]}',
     "Priority must be one of the allowed values"),
    (103, 11, "o_orderdate", '{"min_date": "1996-01-01"}', "Order date must be on or after 1996-01-01"),
]
CUSTOMER_MIN = (104, 7, "c_acctbal", '{"min": 0}', "Account balance must be >= 0")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_rules(spark: SparkSession, source: DataFrame, object_name: str, primary_key: str,
              rules: list[tuple], tables: dict | None = None, window=(None, None),
              thresholds: DataFrame | None = None, test_type: str = "Custodial") -> ValidationResult:
    oid = OBJECT_IDS.get(object_name, 99)
    mappings = [Mapping(mid, rid, oid, col, logic, test_type, desc, object_name, primary_key)
                for mid, rid, col, logic, desc in rules]
    return validate(spark, ObjectRun(oid, object_name, primary_key, source, mappings, CLOCK,
                                     run_id=1, window=window, tables=tables or {},
                                     thresholds=thresholds))


def single_rule(table_name: str, pk: str, mid: int, rid: int, column: str, logic: str, source=None,
                tables=None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir) if source else table(spark, sf_dir, table_name)
        extra = tables(spark, sf_dir) if tables else None
        return run_rules(spark, df, table_name, pk, [(mid, rid, column, logic, "")], extra).report()
    return query


def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def nation_lookups(spark: SparkSession, sf_dir: str) -> dict:
    nation = table(spark, sf_dir, "nation")
    return {"ref.nations_outside_region0": nation.where(F.col("n_regionkey") != 0),
            "ref.nations_in_region0": nation.where(F.col("n_regionkey") == 0)}


# Cross-table rules of our own on the test tables. Finished orders none of whose lines were
# ever sent back by rail, in the run's window:
ORPHANS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus
  FROM `proj.tpch.orders`
  WHERE o_orderstatus = 'F'
    AND NOT EXISTS (SELECT 1 FROM `proj.tpch.lineitem`
                    WHERE l_orderkey = o_orderkey AND l_returnflag <> 'N')
    AND CAST(o_orderdate AS TIMESTAMP) BETWEEN TIMESTAMP '{val_st_dt}' AND TIMESTAMP '{val_end_dt}'"""
ORPHANS_FULL_SQL = ORPHANS_SQL[:ORPHANS_SQL.rindex("    AND CAST(")].rstrip()

# Orders whose lines, discounted and taxed in whole units of 1/10000 of a cent, bill less than a
# tenth of the order's total: the lines are summed per order first, then joined.
BILLED_SQL = """WITH billed AS (
    SELECT l_orderkey, COUNT(*) AS n_lines,
           SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT) * (100 - CAST(ROUND(l_discount * 100) AS BIGINT))
               * (100 + CAST(ROUND(l_tax * 100) AS BIGINT))) AS units
    FROM `proj.tpch.lineitem` GROUP BY l_orderkey)
  SELECT o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS total_cents, n_lines
  FROM `proj.tpch.orders` INNER JOIN billed ON l_orderkey = o_orderkey
  WHERE units < CAST(ROUND(o_totalprice * 100) AS BIGINT) * 1000"""
RECONCILE_SQL = BILLED_SQL + """
    AND o_orderdate >= CAST('{val_st_dt}' AS TIMESTAMP) AND o_orderdate < CAST('{val_end_dt}' AS TIMESTAMP)"""

YEAR_1996 = (dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1))


def business_query(sql: str, mid: int, rid: int, column: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = table(spark, sf_dir, "orders")
        orders.createOrReplaceTempView("tpch_orders")
        table(spark, sf_dir, "lineitem").createOrReplaceTempView("tpch_lineitem")
        window = orders.where((F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                              & (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")))
        return run_rules(spark, window, "orders", "o_orderkey", [(mid, rid, column, sql, "")],
                         window=YEAR_1996, test_type="Business").report()
    return query


def fused_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = run_rules(spark, table(spark, sf_dir, "orders"), "orders", "o_orderkey", MIN_SLICE)
    b = run_rules(spark, table(spark, sf_dir, "customer"), "customer", "c_custkey", [CUSTOMER_MIN])
    return a.report().unionByName(b.report())


def thresholds_frame(spark: SparkSession) -> DataFrame:
    return local_frame(spark, LADDER, "Threshold_ID int, Mapping_ID int, "
                                         "Failure_Threshold_Value double, Criticality int, Active int")


SUMMARY_COLUMNS = ["Mapping_ID", "Rule_ID", "Object_ID", "Run_ID", "Column_Name", "Object_Name",
                   "Rule_Description", "Failure_Count", "Failure_Percent", "Criticality"]


def summary_criticality(spark: SparkSession, sf_dir: str) -> DataFrame:
    th = thresholds_frame(spark)
    a = run_rules(spark, table(spark, sf_dir, "orders"), "orders", "o_orderkey", MIN_SLICE, thresholds=th)
    b = run_rules(spark, table(spark, sf_dir, "customer"), "customer", "c_custkey", [CUSTOMER_MIN],
                  thresholds=th)
    return a.aggregated.unionByName(b.aggregated).select(*SUMMARY_COLUMNS)


def passing_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.plans.engine import passing_rows
    orders = table(spark, sf_dir, "orders")
    result = run_rules(spark, orders, "orders", "o_orderkey", [MIN_SLICE[0]])
    return passing_rows(orders, result).select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_totalprice", "o_orderpriority")


def window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.sources.readers import windowed
    events = windowed(table(spark, sf_dir, "events"), "ts", dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16))
    return events.select("event_id", "user_id", "event_type", "value")


def window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.sources.readers import windowed
    events = windowed(table(spark, sf_dir, "events"), "ts", dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16))
    result = run_rules(spark, events, "events", "event_id", [(201, 6, "event_type", '{"forbidden": ["error"]}', "")])
    return result.counts.select("Mapping_ID", "Failure_Count", "Row_Count")


QUERIES = {
    "rule_not_null": single_rule("documents", "doc_id", 1, 1, "quality", '{"is_nullable": "NO"}',
                                 source=documents_with_labels),
    "rule_regex": single_rule("pages", "page_id", 2, 3, "url", '{"regex": "^https://"}'),
    "rule_regex_part": single_rule("part", "p_partkey", 3, 4, "p_brand", '{"regex": "^Brand#[0-9]$"}'),
    "rule_min": single_rule("customer", "c_custkey", 4, 7, "c_acctbal", '{"min": 0}'),
    "rule_max": single_rule("orders", "o_orderkey", 5, 8, "o_totalprice", '{"max": 450000}'),
    "rule_min_length": single_rule("part", "p_partkey", 6, 9, "p_name", '{"min_length": 9}'),
    "rule_max_length": single_rule("part", "p_partkey", 7, 10, "p_name", '{"max_length": 10}'),
    "rule_min_date": single_rule("orders", "o_orderkey", 8, 11, "o_orderdate", '{"min_date": "1996-01-01"}'),
    "rule_max_date": single_rule("orders", "o_orderkey", 9, 12, "o_orderdate", '{"max_date": "2001-01-01"}'),
    "rule_allowed": single_rule("orders", "o_orderkey", 10, 5, "o_orderpriority",
                                '{"allowed": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]}'),
    "rule_allowed_lookup": single_rule(
        "customer", "c_custkey", 11, 17, "c_nationkey",
        '{"allowed": {"dataset_id": "ref", "table_name": "nations_outside_region0", "column_name": "n_nationkey"}}',
        tables=nation_lookups),
    "rule_forbidden": single_rule("events", "event_id", 12, 6, "event_type", '{"forbidden": ["error"]}'),
    "rule_forbidden_lookup": single_rule(
        "customer", "c_custkey", 13, 18, "c_nationkey",
        '{"forbidden": {"dataset_id": "ref", "table_name": "nations_in_region0", "column_name": "n_nationkey"}}',
        tables=nation_lookups),
    "rule_custom_sql": single_rule(
        "orders", "o_orderkey", 14, 14, "o_totalprice",
        '{"custom_sql": "SELECT * FROM dfSQL WHERE o_totalprice < 5000 AND o_orderstatus = \'F\'"}'),
    "rule_distinct": single_rule("documents", "doc_id", 15, 2, "text", '{"distinct": true}'),
    "rule_distinct_multi": single_rule("lineitem", "l_orderkey, l_partkey, l_suppkey", 16, 2,
                                       "l_orderkey, l_linenumber", '{"distinct": true}'),
    "rule_distinct_key": single_rule("conversations", "conv_id, turn", 17, 2, "conv_id", '{"distinct": true}'),
    "business_orphans": business_query(ORPHANS_SQL, 18, 15, "o_orderkey, o_custkey"),
    "business_reconcile": business_query(RECONCILE_SQL, 19, 16, "total_cents, n_lines"),
    "window_scan": window_scan,
    "window_count": window_count,
    "fused_rules": fused_rules,
    "summary_criticality": summary_criticality,
    "passing_rows": passing_rows_query,
}


# ---- SQL twins ---------------------------------------------------------------------


def _report_sql(mid, rid, oid, column, pk_label, pk_expr, av_expr, rest) -> str:
    return (f"SELECT CAST({mid} AS INTEGER) AS Mapping_ID, CAST({rid} AS INTEGER) AS Rule_ID, "
            f"CAST({oid} AS INTEGER) AS Object_ID, CAST(1 AS INTEGER) AS Run_ID, "
            f"'{column}' AS Column_Name, '{pk_label}' AS Primary_Key_Column_s_, "
            f"{pk_expr} AS Primary_Key_Value_s_, {av_expr} AS Actual_Value {rest}")


def _s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _single_sql(mid, rid, tbl, pk, column, where, source=None) -> str:
    oid = OBJECT_IDS[tbl]
    return _report_sql(mid, rid, oid, column, pk, _s(pk), _s(column),
                       f"FROM {source or tbl} WHERE {where}")


def _dup_sql(mid, tbl, pk_cols, key_cols) -> str:
    oid = OBJECT_IDS[tbl]
    pk_expr = " || ', ' || ".join(_s(c) for c in pk_cols)
    av_expr = " || ', ' || ".join(_s(c) for c in key_cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in key_cols)
    keys = ", ".join(key_cols)
    return _report_sql(mid, 2, oid, ", ".join(key_cols), ", ".join(pk_cols), pk_expr, av_expr,
                       f"FROM {tbl} WHERE {nn} AND ({keys}) IN "
                       f"(SELECT {keys} FROM {tbl} WHERE {nn} GROUP BY {keys} HAVING COUNT(*) > 1)")


# Independent of the rules' text: a semi join's complement and a windowed sum.
_ORPHANS_FULL_ORACLE = """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN
  (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R'))"""
_ORPHANS_ORACLE = _ORPHANS_FULL_ORACLE + (" AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'"
                                          " AND o_orderdate <= TIMESTAMP '1997-01-01 00:00:00'")
_RECONCILE_FULL_ORACLE = """SELECT DISTINCT o_orderkey, total_cents, n_lines, o_orderdate FROM (
  SELECT o_orderkey, o_orderdate, round(o_totalprice * 100)::BIGINT AS total_cents, count(*) OVER w AS n_lines,
         sum(round(l_extendedprice * 100)::HUGEINT * (100 - round(l_discount * 100)::HUGEINT)
             * (100 + round(l_tax * 100)::HUGEINT)) OVER w AS units
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WINDOW w AS (PARTITION BY o_orderkey)) lines
  WHERE units < total_cents * 1000"""
_RECONCILE_ORACLE = (f"SELECT * FROM ({_RECONCILE_FULL_ORACLE}) r WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'"
                     " AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'")

_MIN_SLICE_WHERE = {
    101: "o_totalprice > 450000",
    102: "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')",
    103: "CAST(o_orderdate AS DATE) < DATE '1996-01-01'",
}


def _fused_sql() -> str:
    parts = [_report_sql(mid, rid, 2, col, "o_orderkey", _s("o_orderkey"), _s(col),
                         f"FROM orders WHERE {_MIN_SLICE_WHERE[mid]}")
             for mid, rid, col, _, _ in MIN_SLICE]
    parts.append(_report_sql(104, 7, 1, "c_acctbal", "c_custkey", _s("c_custkey"), _s("c_acctbal"),
                             "FROM customer WHERE c_acctbal < 0"))
    return "\nUNION ALL\n".join(parts)


def _summary_sql() -> str:
    ladder = ", ".join(f"({m}, {v}, {c}, {a})" for _, m, v, c, a in LADDER)
    counts = [f"SELECT {mid} AS Mapping_ID, {rid} AS Rule_ID, 2 AS Object_ID, '{col}' AS Column_Name, "
              f"'orders' AS Object_Name, '{desc}' AS Rule_Description, "
              f"COUNT(*) FILTER (WHERE {_MIN_SLICE_WHERE[mid]}) AS k, COUNT(*) AS n FROM orders"
              for mid, rid, col, _, desc in MIN_SLICE]
    mid, rid, col, _, desc = CUSTOMER_MIN
    counts.append(f"SELECT {mid}, {rid}, 1, '{col}', 'customer', '{desc}', "
                  f"COUNT(*) FILTER (WHERE c_acctbal < 0), COUNT(*) FROM customer")
    return f"""
WITH t(Mapping_ID, thr, tier, active) AS (VALUES {ladder}),
c AS ({' UNION ALL '.join(counts)}),
s AS (SELECT *, CASE WHEN n > 0 AND k > 0 THEN CAST(k AS DOUBLE) / n ELSE CAST(0 AS DOUBLE) END AS pct FROM c)
SELECT CAST(s.Mapping_ID AS INTEGER) AS Mapping_ID, CAST(s.Rule_ID AS INTEGER) AS Rule_ID,
       CAST(s.Object_ID AS INTEGER) AS Object_ID, CAST(1 AS INTEGER) AS Run_ID,
       s.Column_Name, s.Object_Name, s.Rule_Description,
       CAST(s.k AS BIGINT) AS Failure_Count, s.pct AS Failure_Percent,
       CAST((SELECT t.tier FROM t WHERE t.Mapping_ID = s.Mapping_ID AND t.active = 1 AND s.k > 0
              AND CAST(t.thr AS DOUBLE) <= s.pct ORDER BY t.thr DESC, t.tier DESC LIMIT 1) AS INTEGER)
         AS Criticality
FROM s"""


ORACLE_SQL = {
    "rule_not_null": _report_sql(1, 1, 6, "quality", "doc_id", _s("d.doc_id"), _s("l.quality"),
                                 "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id "
                                 "WHERE l.quality IS NULL"),
    "rule_regex": _single_sql(2, 3, "pages", "page_id", "url",
                              "url IS NOT NULL AND NOT regexp_matches(url, '^https://')"),
    "rule_regex_part": _single_sql(3, 4, "part", "p_partkey", "p_brand",
                                   "p_brand IS NOT NULL AND NOT regexp_matches(p_brand, '^Brand#[0-9]$')"),
    "rule_min": _single_sql(4, 7, "customer", "c_custkey", "c_acctbal", "c_acctbal < 0"),
    "rule_max": _single_sql(5, 8, "orders", "o_orderkey", "o_totalprice", "o_totalprice > 450000"),
    "rule_min_length": _single_sql(6, 9, "part", "p_partkey", "p_name", "length(p_name) < 9"),
    "rule_max_length": _single_sql(7, 10, "part", "p_partkey", "p_name", "length(p_name) > 10"),
    "rule_min_date": _single_sql(8, 11, "orders", "o_orderkey", "o_orderdate",
                                 "CAST(o_orderdate AS DATE) < DATE '1996-01-01'"),
    "rule_max_date": _single_sql(9, 12, "orders", "o_orderkey", "o_orderdate",
                                 "CAST(o_orderdate AS DATE) > DATE '2001-01-01'"),
    "rule_allowed": _single_sql(10, 5, "orders", "o_orderkey", "o_orderpriority",
                                "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"),
    "rule_allowed_lookup": _single_sql(
        11, 17, "customer", "c_custkey", "c_nationkey",
        "c_nationkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_regionkey <> 0 "
        "AND n.n_nationkey = c_nationkey)"),
    "rule_forbidden": _single_sql(12, 6, "events", "event_id", "event_type", "event_type = 'error'"),
    "rule_forbidden_lookup": _single_sql(
        13, 18, "customer", "c_custkey", "c_nationkey",
        "EXISTS (SELECT 1 FROM nation n WHERE n.n_regionkey = 0 AND n.n_nationkey = c_nationkey)"),
    "rule_custom_sql": _single_sql(14, 14, "orders", "o_orderkey", "o_totalprice",
                                   "o_totalprice < 5000 AND o_orderstatus = 'F'"),
    "rule_distinct": _dup_sql(15, "documents", ["doc_id"], ["text"]),
    "rule_distinct_multi": _dup_sql(16, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"],
                                    ["l_orderkey", "l_linenumber"]),
    "rule_distinct_key": _dup_sql(17, "conversations", ["conv_id", "turn"], ["conv_id"]),
    "business_orphans": _report_sql(18, 15, 2, "o_orderkey, o_custkey", "o_orderkey", _s("o_orderkey"),
                                    f"{_s('o_orderkey')} || ', ' || {_s('o_custkey')}",
                                    f"FROM ({_ORPHANS_ORACLE}) q"),
    "business_reconcile": _report_sql(19, 16, 2, "total_cents, n_lines", "o_orderkey", _s("o_orderkey"),
                                      f"{_s('total_cents')} || ', ' || {_s('n_lines')}",
                                      f"FROM ({_RECONCILE_ORACLE}) q"),
    "window_scan": "SELECT event_id, user_id, event_type, value FROM events "
                   "WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'",
    "window_count": "SELECT CAST(201 AS INTEGER) AS Mapping_ID, "
                    "CAST(COUNT(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS Failure_Count, "
                    "CAST(COUNT(*) AS BIGINT) AS Row_Count FROM events "
                    "WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'",
    "fused_rules": _fused_sql(),
    "summary_criticality": _summary_sql(),
    "passing_rows": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority "
                    "FROM orders WHERE NOT (o_totalprice > 450000)",
}


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict:
    return dict(ORACLE_SQL)


# ---- profile bindings (F1-F11) -------------------------------------------------------

# Column kinds of the profiled test tables, as their schemas give them.
PROFILE_COLUMNS = {
    "customer": [("c_custkey", "num"), ("c_name", "str"), ("c_nationkey", "num"), ("c_acctbal", "num"),
                 ("c_mktsegment", "str")],
    "part": [("p_partkey", "num"), ("p_name", "str"), ("p_brand", "str"), ("p_type", "str"),
             ("p_size", "num"), ("p_retailprice", "num")],
    "events": [("event_id", "num"), ("ts", "ts"), ("user_id", "num"), ("event_type", "str"),
               ("value", "num"), ("props", "str")],
    "documents_labels": [("doc_id", "num"), ("text", "str"), ("lang", "str"), ("source", "str"),
                         ("n_chars", "num"), ("quality", "num"), ("toxic", "num")],
}
DOCS_LABELS_SQL = ("(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
                   "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")


def _profile_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "documents_labels":
        return documents_with_labels(spark, sf_dir).select(*[c for c, _ in PROFILE_COLUMNS[name]])
    return table(spark, sf_dir, name)


def profile_query(name: str, part: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tessera.operators import profile as PR
        df = _profile_source(spark, sf_dir, name)
        if part == "nulls":
            return PR.column_stats(df).select("column_name", "row_count", "null_count", "null_fraction")
        if part == "minmax":
            return PR.column_stats(df).where(F.col("min_value").isNotNull()).select(
                "column_name", "min_value", "max_value")
        if part == "lengths":
            return PR.column_stats(df).where(F.col("min_length").isNotNull()).select(
                "column_name", "min_length", "max_length")
        if part == "flags":
            return PR.column_stats(df).where(F.col("dtype") == "string").select(
                "column_name", "looks_like_email", "looks_like_date")
        names = F.create_map(*[x for i, f in enumerate(df.schema.fields) for x in (F.lit(i), F.lit(f.name))])
        if part == "distinct":
            return PR.distinct_counts(df).select(names[F.col("ordinal")].alias("column_name"), "distinct_count")
        if part == "samples":
            return PR.sample_values(df).select(names[F.col("ordinal")].alias("column_name"),
                                               "sample_rank", "sample_value")
        if part == "suggest":
            return PR.suggest_rules(df)
        raise ValueError(part)
    return query


def _src(name: str) -> str:
    return DOCS_LABELS_SQL if name == "documents_labels" else name


def _profile_sql(name: str, part: str) -> str:
    src, cols, parts = _src(name), PROFILE_COLUMNS[name], []
    for c, kind in cols:
        if part == "nulls":
            parts.append(f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, "
                         f"COUNT(*) - COUNT({c}) AS null_count, CASE WHEN COUNT(*) > 0 THEN "
                         f"CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*) ELSE 0.0 END AS null_fraction FROM {src}")
        elif part == "minmax" and kind == "num":
            parts.append(f"SELECT '{c}' AS column_name, MIN(CAST({c} AS DOUBLE)) AS min_value, "
                         f"MAX(CAST({c} AS DOUBLE)) AS max_value FROM {src} HAVING COUNT({c}) > 0")
        elif part == "lengths" and kind == "str":
            parts.append(f"SELECT '{c}' AS column_name, CAST(MIN(length({c})) AS INTEGER) AS min_length, "
                         f"CAST(MAX(length({c})) AS INTEGER) AS max_length FROM {src} HAVING COUNT({c}) > 0")
        elif part == "flags" and kind == "str":
            parts.append(f"SELECT '{c}' AS column_name, COALESCE(bool_and(regexp_matches({c}, "
                         f"'^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')), false) AS looks_like_email, "
                         f"COALESCE(bool_and(TRY_CAST({c} AS TIMESTAMP) IS NOT NULL), false) AS looks_like_date "
                         f"FROM {src}")
        elif part == "distinct":
            parts.append(f"SELECT '{c}' AS column_name, COUNT(DISTINCT CAST({c} AS VARCHAR)) AS distinct_count "
                         f"FROM {src} HAVING COUNT({c}) > 0")
        elif part == "samples":
            key = f"CAST({c} AS DOUBLE)" if kind == "num" else "CAST(NULL AS DOUBLE)"
            parts.append(
                f"SELECT '{c}' AS column_name, CAST(sample_rank AS INTEGER) AS sample_rank, "
                f"CASE WHEN length(v) > 80 THEN substr(v, 1, 80) || '…' ELSE v END AS sample_value FROM "
                f"(SELECT v, row_number() OVER (ORDER BY k ASC NULLS LAST, v ASC) AS sample_rank FROM "
                f"(SELECT CAST({c} AS VARCHAR) AS v, MIN({key}) AS k FROM {src} WHERE {c} IS NOT NULL GROUP BY 1)) "
                f"WHERE sample_rank <= 5")
        elif part == "suggest":
            n = f"(SELECT COUNT(*) FROM {src})"
            parts.append(f"SELECT '{c}' AS column_name, 'is_nullable' AS test_key, 'NO' AS test_value "
                         f"FROM {src} HAVING COUNT(*) > 0 AND COUNT({c}) = COUNT(*)")
            parts.append(f"SELECT '{c}', 'distinct', 'true' FROM {src} HAVING COUNT(*) > 0 AND "
                         f"COUNT({c}) = COUNT(*) AND COUNT(DISTINCT CAST({c} AS VARCHAR)) = COUNT(*)")
            if kind == "num":
                for agg in ("min", "max"):
                    parts.append(f"SELECT '{c}', '{agg}', CAST({agg.upper()}(CAST({c} AS DOUBLE)) AS VARCHAR) "
                                 f"FROM {src} HAVING COUNT({c}) > 0")
            if kind == "str":
                parts.append(f"SELECT '{c}', 'regex', '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$' FROM {src} "
                             f"HAVING COUNT({c}) > 0 AND bool_and(regexp_matches({c}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'))")
                parts.append(f"SELECT '{c}', 'allowed', '[' || string_agg('\"' || v || '\"', ',' ORDER BY v) || ']' FROM "
                             f"(SELECT DISTINCT {c} AS v FROM {src} WHERE {c} IS NOT NULL) "
                             f"HAVING COUNT(*) BETWEEN 1 AND 10 AND COUNT(*) < {n}")
                for agg, key in (("MIN", "min_length"), ("MAX", "max_length")):
                    parts.append(f"SELECT '{c}', '{key}', CAST({agg}(length({c})) AS VARCHAR) "
                                 f"FROM {src} HAVING COUNT({c}) > 0")
    return "\nUNION ALL\n".join(parts)


FLAG_COLUMNS = ["mail", "mail_gap", "iso", "compact", "month", "named", "mixed", "status"]


def profile_flags_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8, F9 on text made of given columns: e-mail and date texts in several forms, with gaps and strays."""
    from tessera.operators import profile as PR
    day = F.col("o_orderdate")
    mail = F.concat(F.lit("buyer"), F.col("o_custkey").cast("string"), F.lit("@example.com"))
    texts = table(spark, sf_dir, "orders").select(
        mail.alias("mail"), F.when(F.col("o_orderkey") % 3 > 0, mail).alias("mail_gap"), F.date_format(day, "yyyy-MM-dd").alias("iso"),
        F.date_format(day, "yyyyMMdd").alias("compact"), F.date_format(day, "yyyy-MM").alias("month"),
        F.date_format(day, "MMM d yyyy").alias("named"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.col("o_orderpriority")).alias("mixed"),
        F.col("o_orderstatus").alias("status"))
    return PR.column_stats(texts).select("column_name", "looks_like_email", "looks_like_date")


_FLAGS_POSITIVE_SQL = """
    WITH t AS (SELECT 'buyer' || o_custkey || '@example.com' AS mail,
        CASE WHEN o_orderkey % 3 > 0 THEN 'buyer' || o_custkey || '@example.com' END AS mail_gap,
        strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%Y-%m') AS month,
        strftime(o_orderdate, '%b %-d %Y') AS named,
        CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE o_orderpriority END AS mixed,
        o_orderstatus AS status FROM orders)
    """ + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, coalesce(bool_and(regexp_matches({c}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$')), false) AS looks_like_email, "
    f"coalesce(bool_and(try_strptime({c}, ['%Y-%m-%d', '%Y%m%d', '%Y-%m', '%b %-d %Y']) IS NOT NULL), false) AS looks_like_date FROM t"
    for c in FLAG_COLUMNS)

PROFILE_BINDINGS = {
    "profile_nulls": ("documents_labels", "nulls"),
    "profile_distinct": ("part", "distinct"),
    "profile_minmax": ("customer", "minmax"),
    "profile_lengths": ("part", "lengths"),
    "profile_samples": ("events", "samples"),
    "profile_samples_text": ("documents_labels", "samples"),
    "profile_flags": ("customer", "flags"),
    "suggest_rules": ("customer", "suggest"),
    "suggest_rules_events": ("events", "suggest"),
}
QUERIES.update({k: profile_query(*v) for k, v in PROFILE_BINDINGS.items()})
ORACLE_SQL.update({k: _profile_sql(*v) for k, v in PROFILE_BINDINGS.items()})


# ---- alert routing over table-derived aggregates (N1, N2, J7, J8) ---------------------

# Uneven tiers, several contacts per route, and objects without a route for some tier.
ROUTE_HANDLERS = [(4, "note in the weekly digest"), (7, "open a ticket for the owning team"), (9, "stop the load and call the owner")]
ROUTE_CONTACTS = [(11, "digest@data.invalid"), (12, "owners@data.invalid"), (13, "oncall@data.invalid"), (14, "audit@data.invalid")]
ROUTE_NOTIFICATIONS = [(1, 11, 4), (2, 12, 7), (3, 13, 9), (4, 14, 9), (5, 14, 7)]
# (Object_Notification_ID, ObjectID, Notification_ID, Criticality)
ROUTE_OBJECTS = [(1, 2, 1, 1), (2, 2, 3, 3), (3, 2, 4, 3), (4, 2, 2, 2), (5, 2, 5, 2), (6, 1, 1, 1), (7, 1, 2, 2)]


def routing_catalog(spark: SparkSession):
    from tessera.plans.catalog import Catalog
    return Catalog.from_rows(spark, handler=ROUTE_HANDLERS, distribution=ROUTE_CONTACTS,
                             notification=ROUTE_NOTIFICATIONS, object_notification=ROUTE_OBJECTS)


def _summary_aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    th = thresholds_frame(spark)
    a = run_rules(spark, table(spark, sf_dir, "orders"), "orders", "o_orderkey", MIN_SLICE, thresholds=th)
    b = run_rules(spark, table(spark, sf_dir, "customer"), "customer", "c_custkey", [CUSTOMER_MIN], thresholds=th)
    return a.aggregated.unionByName(b.aggregated)


def alerts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators import alerts
    return alerts.alert_rows(_summary_aggregated(spark, sf_dir), routing_catalog(spark))


def recipients_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators import alerts
    return alerts.recipients(_summary_aggregated(spark, sf_dir), routing_catalog(spark)).drop("Notification_ID")


def alerts_min_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A route fires for every tier at or above its own."""
    from tessera.operators import alerts
    return alerts.alert_rows(_summary_aggregated(spark, sf_dir), routing_catalog(spark), "min")


def _routing_sql(with_contacts: bool, compare: str = "=") -> str:
    h = ", ".join(f"({i}, '{t}')" for i, t in ROUTE_HANDLERS)
    c = ", ".join(f"({i}, '{t}')" for i, t in ROUTE_CONTACTS)
    n = ", ".join(str(x) for x in ROUTE_NOTIFICATIONS)
    o = ", ".join(str(x) for x in ROUTE_OBJECTS)
    join = "JOIN" if with_contacts else "LEFT JOIN"
    extra = ", r.contact AS Contact_email" if with_contacts else ""
    return f"""
WITH agg AS ({_summary_sql()}),
h(hid, txt) AS (VALUES {h}), c(cid, contact) AS (VALUES {c}), n(nid, cid, hid) AS (VALUES {n}),
o(onid, oid, nid, crit) AS (VALUES {o}),
r AS (SELECT o.oid, o.crit, h.txt, c.contact FROM o LEFT JOIN n ON o.nid = n.nid
      LEFT JOIN h ON n.hid = h.hid LEFT JOIN c ON n.cid = c.cid)
SELECT {"" if with_contacts else "DISTINCT "}a.Column_Name, a.Rule_ID, a.Object_ID, a.Run_ID, a.Criticality, a.Object_Name,
       a.Rule_Description, r.txt AS Notification_Handler_Text{extra}
FROM agg a {join} r ON a.Object_ID = r.oid AND r.crit {compare} a.Criticality
WHERE a.Criticality IS NOT NULL"""


# ---- declared-schema conformance on orders (P15, P16, S9) ------------------------------

ORDERS_DECLARED = [("o_orderkey", "INT64", "NO"), ("o_custkey", "INT64", "NO"), ("o_orderstatus", "STRING", "NO"),
                   ("o_totalprice", "INT64", "YES"), ("o_orderdate", "DATE", "YES"),
                   ("o_orderpriority", "STRING", "YES"), ("o_clerk", "STRING", "YES")]


def type_check_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    m = Mapping(40, 13, 2, "", "{}", "Custodial", "types", "orders", "o_orderkey")
    r = validate(spark, ObjectRun(2, "orders", "o_orderkey", orders, [m], CLOCK, declared=ORDERS_DECLARED))
    return r.report()


LABELLED_DECLARED = [("doc_id", "INT64", "NO"), ("text", "STRING", "YES"), ("n_chars", "BOOL", "YES"), ("quality", "NUMERIC", "YES"),
                     ("toxic", "INT64", "NO"), ("source", "GEOGRAPHY", "YES")]


def type_check_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 where declared NOT NULL columns do hold NULLs: documents beside their labels."""
    m = Mapping(41, 13, 6, "", "{}", "Custodial", "types", "documents", "doc_id")
    return validate(spark, ObjectRun(6, "documents", "doc_id", documents_with_labels(spark, sf_dir), [m], CLOCK,
                                     declared=LABELLED_DECLARED)).report()


def schema_diff_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.schema_check import schema_diff
    return schema_diff(spark, table(spark, sf_dir, "orders"), ORDERS_DECLARED, 2)


def _spark_type_sql(col: str) -> str:
    return (f"CASE {col} WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
            f"WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' "
            f"WHEN 'BOOLEAN' THEN 'boolean' ELSE lower({col}) END")


def _type_check_sql() -> str:
    # Spelled out here for the declared types above, apart from the engine's matrix.
    fits = {"INT64": ["int", "tinyint", "smallint", "bigint", "string"], "DATE": ["timestamp", "date", "string"],
            "STRING": ["timestamp", "date", "boolean", "float", "int", "tinyint", "smallint", "bigint", "double", "decimal", "string"]}
    decl = ", ".join(f"('{c}', '{t}', '{n}')" for c, t, n in ORDERS_DECLARED)
    accepted = ", ".join(f"('{k}', '{v}')" for k, vs in fits.items() for v in vs)
    return f"""
WITH d(col, declared, nullable) AS (VALUES {decl}),
acc(declared, fam) AS (VALUES {accepted}),
actual AS (SELECT column_name AS col, {_spark_type_sql('data_type')} AS stype
           FROM information_schema.columns WHERE table_name = 'orders'),
fam AS (SELECT col, stype, CASE WHEN stype = 'timestamp_ntz' THEN 'timestamp'
                                WHEN stype LIKE 'decimal%' THEN 'decimal' ELSE stype END AS fam FROM actual)
SELECT CAST(40 AS INTEGER) AS Mapping_ID, CAST(13 AS INTEGER) AS Rule_ID, CAST(2 AS INTEGER) AS Object_ID,
       CAST(1 AS INTEGER) AS Run_ID, '' AS Column_Name, 'o_orderkey' AS Primary_Key_Column_s_,
       f.col || ' detected as ' || f.stype || ' type. Schema specifies ' || d.declared || ' type.'
         AS Primary_Key_Value_s_, f.col AS Actual_Value
FROM d JOIN fam f ON d.col = f.col
WHERE NOT EXISTS (SELECT 1 FROM acc WHERE acc.declared = d.declared AND acc.fam = f.fam)
UNION ALL
SELECT 40, 13, 2, 1, '', 'o_orderkey', CAST(o_orderkey AS VARCHAR), NULL FROM orders
WHERE o_orderkey IS NULL OR o_custkey IS NULL
UNION ALL
SELECT 40, 13, 2, 1, '', 'o_orderkey', CAST(o_orderkey AS VARCHAR), NULL FROM orders
WHERE o_orderstatus IS NULL"""


def _schema_diff_sql() -> str:
    decl = ", ".join(f"('{c}')" for c, _, _ in ORDERS_DECLARED)
    return f"""
WITH d(col) AS (VALUES {decl}),
a AS (SELECT column_name AS col FROM information_schema.columns WHERE table_name = 'orders')
SELECT CAST(2 AS INTEGER) AS Object_ID, col AS Column_Name, 'missing' AS Finding,
       'declared but absent' AS Detail FROM d WHERE col NOT IN (SELECT col FROM a)
UNION ALL
SELECT 2, col, 'extra', 'present but not declared' FROM a WHERE col NOT IN (SELECT col FROM d)
UNION ALL
SELECT 2, NULL, 'column_count', (SELECT COUNT(*) FROM a) || ' present, ' || (SELECT COUNT(*) FROM d) || ' declared'
WHERE (SELECT COUNT(*) FROM a) <> (SELECT COUNT(*) FROM d)"""


# ---- the flagship: twelve row rules on lineitem, one scan ------------------------------

LINEITEM_PK = "l_orderkey, l_linenumber"
LINEITEM_RULES = [  # (Mapping_ID, Rule_ID, column, logic, [SQL failing condition per key])
    (301, 7, "l_quantity", '{"min": 1, "max": 50}', ["l_quantity < 1", "l_quantity > 50"]),
    (302, 8, "l_extendedprice", '{"max": 100000}', ["l_extendedprice > 100000"]),
    (303, 7, "l_discount", '{"min": 0, "max": 0.1}', ["l_discount < 0", "l_discount > 0.1"]),
    (304, 8, "l_tax", '{"max": 0.08}', ["l_tax > 0.08"]),
    (305, 5, "l_returnflag", '{"allowed": ["A", "N", "R"]}', ["l_returnflag NOT IN ('A', 'N', 'R')"]),
    (306, 5, "l_linestatus", '{"allowed": ["O", "F"], "is_nullable": "NO"}',
     ["l_linestatus NOT IN ('O', 'F')", "l_linestatus IS NULL"]),
    (307, 11, "l_shipdate", '{"min_date": "1992-01-01", "max_date": "1998-12-31"}',
     ["CAST(l_shipdate AS DATE) < DATE '1992-01-01'", "CAST(l_shipdate AS DATE) > DATE '1998-12-31'"]),
    (308, 1, "l_orderkey", '{"is_nullable": "NO"}', ["l_orderkey IS NULL"]),
    (309, 3, "l_returnflag", '{"regex": "^[ANR]$"}', ["NOT regexp_matches(l_returnflag, '^[ANR]$')"]),
    (310, 7, "l_linenumber", '{"min": 1, "max": 7}', ["l_linenumber < 1", "l_linenumber > 7"]),
    (311, 7, "l_partkey", '{"min": 1}', ["l_partkey < 1"]),
    (312, 6, "l_suppkey", '{"forbidden": [0]}', ["l_suppkey IN (0)"]),
]


def fused_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [(mid, rid, col, logic, "") for mid, rid, col, logic, _ in LINEITEM_RULES]
    return run_rules(spark, table(spark, sf_dir, "lineitem"), "lineitem", LINEITEM_PK, rules).report()


def _fused_lineitem_sql() -> str:
    pk = f"{_s('l_orderkey')} || ', ' || {_s('l_linenumber')}"
    parts = [_report_sql(mid, rid, 7, col, LINEITEM_PK, pk, _s(col), f"FROM lineitem WHERE {cond}")
             for mid, rid, col, _, conds in LINEITEM_RULES for cond in conds]
    return "\nUNION ALL\n".join(parts)


def lookup_lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"tpch.part": table(spark, sf_dir, "part"),
              "tpch.big_suppliers": table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 9000)}
    rules = [(320, 17, "l_partkey", '{"allowed": {"dataset_id": "tpch", "table_name": "part", '
                                    '"column_name": "p_partkey"}}', ""),
             (321, 18, "l_suppkey", '{"forbidden": {"dataset_id": "tpch", "table_name": "big_suppliers", '
                                    '"column_name": "s_suppkey"}}', "")]
    return run_rules(spark, table(spark, sf_dir, "lineitem"), "lineitem", LINEITEM_PK, rules, tables).report()


def _lookup_lineitem_sql() -> str:
    pk = f"{_s('l_orderkey')} || ', ' || {_s('l_linenumber')}"
    return "\nUNION ALL\n".join([
        _report_sql(320, 17, 7, "l_partkey", LINEITEM_PK, pk, _s("l_partkey"),
                    "FROM lineitem WHERE l_partkey IS NOT NULL AND NOT EXISTS "
                    "(SELECT 1 FROM part WHERE p_partkey = l_partkey)"),
        _report_sql(321, 18, 7, "l_suppkey", LINEITEM_PK, pk, _s("l_suppkey"),
                    "FROM lineitem WHERE EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 9000 "
                    "AND s_suppkey = l_suppkey)"),
    ])


def business_orphans_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("tpch_orders")
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("tpch_lineitem")
    return run_rules(spark, orders, "orders", "o_orderkey", [(22, 15, "o_orderkey, o_custkey", ORPHANS_FULL_SQL + ";", "")],
                     test_type="Business").report()


# ---- catalog merge fed by rule proposals on customer (C1-C5, F11) ----------------------

def catalog_merge_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators import merge
    from tessera.operators import profile as PR
    from tessera.plans.catalog import Catalog
    proposals = PR.candidate_rule_logic(PR.suggest_rules(table(spark, sf_dir, "customer")))
    candidates = proposals.select(
        F.concat(F.lit("r_"), F.col("column_name")).alias("rule_id_temp"), F.lit("Custodial").alias("test_type"),
        "column_name", F.concat(F.lit("proposed for "), F.col("column_name")).alias("rule_description"),
        F.col("rule_logic"), F.lit(0.9).alias("confidence"), F.lit(True).alias("include"))
    existing_logic = '{"min_length": 18, "max_length": 18, "is_nullable": "NO", "distinct": true}'
    catalog = Catalog.from_rows(
        spark, rule=[(1, "name shape", existing_logic, "Custodial")],
        object_lookup=[(1, "customer", "tpch", None, "c_custkey", "full table", None, None, 1)],
        rule_mapping=[(1, 1, 1, "c_name", None, None, "Custodial", 1)],
        rule_threshold=[])
    result = merge.merge(spark, catalog, candidates, "customer", "tpch", "c_custkey")
    return (result.mappings.join(result.rules.drop("Test_Type"), "Rule_ID").join(result.thresholds, "Mapping_ID")
            .select("Mapping_ID", "Rule_ID", "Object_ID", "Column_Name", "Rule_Logic", "Test_Type",
                    F.col("Failure_Threshold_Value").cast("double").alias("Failure_Threshold_Value"),
                    "Criticality"))


def business_reconcile_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("tpch_orders")
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("tpch_lineitem")
    return run_rules(spark, orders, "orders", "o_orderkey", [(23, 16, "total_cents, n_lines", BILLED_SQL, "")],
                     test_type="Business").report()


def lookup_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 with a lookup that grows like the checked table: lines of orders still open."""
    still_open = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    rules = [(322, 18, "l_orderkey", '{"forbidden": {"dataset_id": "tpch", "table_name": "open_orders", '
                                     '"column_name": "o_orderkey"}}', "")]
    return run_rules(spark, table(spark, sf_dir, "lineitem"), "lineitem", LINEITEM_PK, rules,
                     {"tpch.open_orders": still_open}).report()


def distinct_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 where every key is hot: a handful of event types over all events."""
    return run_rules(spark, table(spark, sf_dir, "events"), "events", "event_id",
                     [(323, 2, "event_type", '{"distinct": true}', "")]).report()


def passing_rows_all_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6 behind row, uniqueness, lookup and SQL rules at once."""
    small = table(spark, sf_dir, "part").where(F.col("p_size") <= 10)
    rules = [(324, 7, "l_quantity", '{"min": 5}', ""),
             (325, 2, "l_partkey, l_suppkey, l_shipdate", '{"distinct": true}', ""),
             (326, 17, "l_partkey", '{"forbidden": {"dataset_id": "tpch", "table_name": "small_parts", '
                                    '"column_name": "p_partkey"}}', ""),
             (327, 14, "l_returnflag", '{"custom_sql": "SELECT * FROM dfSQL WHERE l_returnflag = \'R\'"}', "")]
    lines = table(spark, sf_dir, "lineitem")
    result = run_rules(spark, lines, "lineitem", LINEITEM_PK, rules, {"tpch.small_parts": small})
    return passing_rows(lines, result).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


QUERIES.update({
    "type_check_nulls": type_check_nulls,
    "profile_flags_positive": profile_flags_positive,
    "business_reconcile_full": business_reconcile_full,
    "lookup_large": lookup_large,
    "distinct_hot": distinct_hot,
    "passing_rows_all_kinds": passing_rows_all_kinds,
})
ORACLE_SQL.update({
    "type_check_nulls": """
        SELECT 41::INTEGER AS Mapping_ID, 13::INTEGER AS Rule_ID, 6::INTEGER AS Object_ID, 1::INTEGER AS Run_ID, '' AS Column_Name,
               'doc_id' AS Primary_Key_Column_s_, 'n_chars detected as bigint type. Schema specifies BOOL type.' AS Primary_Key_Value_s_,
               'n_chars' AS Actual_Value WHERE (SELECT count(*) FROM documents) > 0
        UNION ALL
        SELECT 41, 13, 6, 1, '', 'doc_id', doc_id::VARCHAR, NULL FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL""",
    "profile_flags_positive": _FLAGS_POSITIVE_SQL,
    "business_reconcile_full": _report_sql(23, 16, 2, "total_cents, n_lines", "o_orderkey", _s("o_orderkey"),
                                           f"{_s('total_cents')} || ', ' || {_s('n_lines')}",
                                           f"FROM ({_RECONCILE_FULL_ORACLE}) q"),
    "lookup_large": _report_sql(322, 18, 7, "l_orderkey", LINEITEM_PK, f"{_s('l_orderkey')} || ', ' || {_s('l_linenumber')}",
                                _s("l_orderkey"), "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'"),
    "distinct_hot": _dup_sql(323, "events", ["event_id"], ["event_type"]),
    "passing_rows_all_kinds": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
          SELECT *, count(*) OVER (PARTITION BY l_partkey, l_suppkey, l_shipdate) AS same,
                 bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey, l_linenumber) AS returned FROM lineitem) l
        WHERE l_quantity >= 5 AND (same = 1 OR l_partkey IS NULL OR l_suppkey IS NULL OR l_shipdate IS NULL)
          AND NOT returned AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 10)""",
})

QUERIES.update({
    "alerts": alerts_query,
    "alerts_min": alerts_min_query,
    "alert_recipients": recipients_query,
    "type_check": type_check_query,
    "schema_diff": schema_diff_query,
    "fused_lineitem": fused_lineitem,
    "lookup_lineitem_part": lookup_lineitem_part,
    "business_orphans_full": business_orphans_full,
    "catalog_merge": catalog_merge_query,
})
ORACLE_SQL.update({
    "alerts": _routing_sql(False),
    "alerts_min": _routing_sql(False, "<="),
    "alert_recipients": _routing_sql(True),
    "type_check": _type_check_sql(),
    "schema_diff": _schema_diff_sql(),
    "fused_lineitem": _fused_lineitem_sql(),
    "lookup_lineitem_part": _lookup_lineitem_sql(),
    "business_orphans_full": _report_sql(22, 15, 2, "o_orderkey, o_custkey", "o_orderkey", _s("o_orderkey"),
                                         f"{_s('o_orderkey')} || ', ' || {_s('o_custkey')}",
                                         f"FROM ({_ORPHANS_FULL_ORACLE}) q"),
})


# ---- more reference behaviours on the test tables -------------------------------------

EVENTS_DAY = (dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16))


def current_date_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 with the literal CURRENT_DATE: the run clock's day is the bound."""
    clock = RunClock.fixed("2024-01-15 09:30:00")
    m = Mapping(330, 12, 5, "ts", '{"max_date": "CURRENT_DATE"}', "Custodial", "", "events", "event_id")
    return validate(spark, ObjectRun(5, "events", "event_id", table(spark, sf_dir, "events"), [m], clock)).report()


def formatted_date_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 with ``[value, format]``: the format reads the column's text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("order_day"))
    return run_rules(spark, orders, "orders", "o_orderkey",
                     [(331, 11, "order_day", '{"min_date": ["1996-01-01", "dd/MM/yyyy"]}', "")]).report()


def text_length_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 on whole document texts."""
    return run_rules(spark, table(spark, sf_dir, "documents"), "documents", "doc_id",
                     [(332, 10, "text", '{"max_length": 20000}', "")]).report()


def not_null_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on a column pair: a row fails when any part is NULL."""
    return run_rules(spark, documents_with_labels(spark, sf_dir), "documents", "doc_id",
                     [(333, 1, "quality, toxic", '{"is_nullable": "NO"}', "")]).report()


def allowed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 with numbers on an int column."""
    sizes = ", ".join(str(i) for i in range(1, 26))
    return run_rules(spark, table(spark, sf_dir, "part"), "part", "p_partkey",
                     [(334, 5, "p_size", '{"allowed": [' + sizes + ']}', "")]).report()


def window_rules_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + A1 + P11: rules on one day's window; uniqueness is judged inside the window."""
    from tessera.sources.readers import windowed
    events = windowed(table(spark, sf_dir, "events"), "ts", *EVENTS_DAY)
    return run_rules(spark, events, "events", "event_id",
                     [(335, 2, "user_id", '{"distinct": true}', ""),
                      (336, 6, "event_type", '{"forbidden": ["error"]}', "")], window=EVENTS_DAY).report()


_DAY = "ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'"

QUERIES.update({
    "rule_max_current_date": current_date_rule,
    "rule_min_date_format": formatted_date_rule,
    "rule_max_length_text": text_length_rule,
    "rule_not_null_pair": not_null_pair,
    "rule_allowed_numbers": allowed_numbers,
    "window_rules_events": window_rules_events,
})
ORACLE_SQL.update({
    "rule_max_current_date": _report_sql(330, 12, 5, "ts", "event_id", _s("event_id"), _s("ts"),
                                         "FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15'"),
    "rule_min_date_format": _report_sql(331, 11, 2, "order_day", "o_orderkey", _s("o_orderkey"),
                                        "strftime(o_orderdate, '%d/%m/%Y')",
                                        "FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1996-01-01'"),
    "rule_max_length_text": _single_sql(332, 10, "documents", "doc_id", "text", "length(text) > 20000"),
    "rule_not_null_pair": _report_sql(333, 1, 6, "quality, toxic", "doc_id", _s("d.doc_id"),
                                      f"{_s('l.quality')} || ', ' || {_s('l.toxic')}",
                                      "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id "
                                      "WHERE l.quality IS NULL OR l.toxic IS NULL"),
    "rule_allowed_numbers": _single_sql(334, 5, "part", "p_partkey", "p_size",
                                        "p_size NOT IN (" + ", ".join(str(i) for i in range(1, 26)) + ")"),
    "window_rules_events": "\nUNION ALL\n".join([
        _report_sql(335, 2, 5, "user_id", "event_id", _s("event_id"), _s("user_id"),
                    f"FROM events WHERE {_DAY} AND user_id IN (SELECT user_id FROM events WHERE {_DAY} "
                    "GROUP BY user_id HAVING COUNT(*) > 1)"),
        _report_sql(336, 6, 5, "event_type", "event_id", _s("event_id"), _s("event_type"),
                    f"FROM events WHERE {_DAY} AND event_type = 'error'"),
    ]),
})


def _catalog_merge_sql() -> str:
    """Proposals per column (same rules as suggest_rules), as sorted-key JSON; the
    candidate equal to the catalog's existing c_name rule is skipped; new ids
    continue after 1 in candidate order; every proposal has a hard key, so the
    default threshold is (0.0, 3)."""
    email = "^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$"
    email_json = email.replace("\\", "\\\\")
    per_column = []
    for c, kind in PROFILE_COLUMNS["customer"]:
        num, text = kind == "num", kind == "str"
        pieces = []
        if text:
            pieces.append(f"CASE WHEN d BETWEEN 1 AND 10 AND d < n THEN '\"allowed\": [' || "
                          f"(SELECT string_agg('\"' || v || '\"', ', ' ORDER BY v) FROM "
                          f"(SELECT DISTINCT {c} AS v FROM customer WHERE {c} IS NOT NULL)) || ']' END")
        pieces.append("CASE WHEN n > 0 AND nn = n AND d = n THEN '\"distinct\": true' END")
        pieces.append("CASE WHEN n > 0 AND nn = n THEN '\"is_nullable\": \"NO\"' END")
        if num:
            pieces.append("CASE WHEN nn > 0 THEN '\"max\": ' || CAST(hi AS VARCHAR) END")
        if text:
            pieces.append("CASE WHEN nn > 0 THEN '\"max_length\": ' || CAST(lh AS VARCHAR) END")
        if num:
            pieces.append("CASE WHEN nn > 0 THEN '\"min\": ' || CAST(lo AS VARCHAR) END")
        if text:
            pieces.append("CASE WHEN nn > 0 THEN '\"min_length\": ' || CAST(ll AS VARCHAR) END")
            pieces.append(f"CASE WHEN nn > 0 AND em THEN '\"regex\": \"{email_json}\"' END")
        stats = (f"SELECT COUNT(*) AS n, COUNT({c}) AS nn, COUNT(DISTINCT CAST({c} AS VARCHAR)) AS d"
                 + (f", MIN(CAST({c} AS DOUBLE)) AS lo, MAX(CAST({c} AS DOUBLE)) AS hi" if num else "")
                 + (f", MIN(length({c})) AS ll, MAX(length({c})) AS lh, "
                    f"bool_and(regexp_matches({c}, '{email}')) AS em" if text else "")
                 + " FROM customer")
        per_column.append(f"SELECT '{c}' AS Column_Name, '{{' || concat_ws(', ', {', '.join(pieces)}) || '}}' "
                          f"AS Rule_Logic FROM ({stats})")
    existing = '{"distinct": true, "is_nullable": "NO", "max_length": 18, "min_length": 18}'
    return f"""
WITH p AS ({' UNION ALL '.join(per_column)}),
fresh AS (SELECT * FROM p WHERE Rule_Logic <> '{{}}'
          AND NOT (Column_Name = 'c_name' AND Rule_Logic = '{existing}')),
n AS (SELECT *, row_number() OVER (ORDER BY 'r_' || Column_Name) AS k FROM fresh)
SELECT CAST(1 + k AS INTEGER) AS Mapping_ID, CAST(1 + k AS INTEGER) AS Rule_ID, CAST(1 AS INTEGER) AS Object_ID,
       Column_Name, Rule_Logic, 'Custodial' AS Test_Type,
       CASE WHEN Rule_Logic LIKE '%"is_nullable"%' OR Rule_Logic LIKE '%"distinct"%' THEN CAST(0.0 AS DOUBLE)
            ELSE CAST(0.01 AS DOUBLE) END AS Failure_Threshold_Value,
       CAST(CASE WHEN Rule_Logic LIKE '%"is_nullable"%' OR Rule_Logic LIKE '%"distinct"%' THEN 3 ELSE 2 END
            AS INTEGER) AS Criticality
FROM n"""


ORACLE_SQL["catalog_merge"] = _catalog_merge_sql()
