"""Key, lookup, SQL, business and schema checks; summary; properties; plan shape."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tessera.operators import sqlrules
from tessera.plans.engine import ObjectRun, passing_rows, validate
from tests.conftest import SF001
from tests.fixtures import CLOCK, customers, mapping, orders


def run(spark, df, mappings, pk="customer_id", **kw):
    return validate(spark, ObjectRun(1, "customers", pk, df, mappings, CLOCK, **kw))


def pairs(r):
    return sorted(((x["Mapping_ID"], x["Primary_Key_Value_s_"], x["Actual_Value"]) for x in r.detailed.collect()),
                  key=lambda t: tuple("" if v is None else str(v) for v in t))


def test_distinct_reports_every_occurrence_and_skips_nulls(spark):
    r = run(spark, customers(spark), [mapping(1, "customer_id", '{"distinct": true}')])
    assert pairs(r) == [(1, "3", "3"), (1, "3", "3")]


def test_distinct_multi_column_null_part_is_not_a_duplicate(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 3), (1, None, 4)], "k int, j string, id int")
    r = run(spark, df, [mapping(1, "k, j", '{"distinct": true}', pk="id")], pk="id")
    assert pairs(r) == [(1, "1", "1, a"), (1, "2", "1, a")]


def test_lookup_allowed_and_forbidden(spark):
    ref = spark.createDataFrame([("Active",), ("Closed",), (None,)], "s string")
    logic = '{"allowed": {"table_name": "statuses", "column_name": "s"}}'
    r = run(spark, customers(spark), [mapping(1, "status", logic)], tables={"statuses": ref})
    assert pairs(r) == [(1, None, "Pending"), (1, "3", "Deleted")]
    logic = '{"forbidden": {"table_name": "statuses", "column_name": "s"}}'
    r = run(spark, customers(spark), [mapping(1, "status", logic)], tables={"statuses": ref})
    assert sorted(p[1] for p in pairs(r)) == ["1", "2", "6"]


def test_lookup_unknown_table_is_a_rule_error(spark):
    r = run(spark, customers(spark), [mapping(1, "status", '{"allowed": {"table_name": "nope", "column_name": "s"}}')])
    assert r.rule_errors.count() == 1


def test_custom_sql_on_dfsql_view(spark):
    logic = '{"custom_sql": "SELECT * FROM dfSQL WHERE score < 0 AND status = \'Deleted\'"}'
    r = run(spark, customers(spark), [mapping(1, "score", logic)])
    assert pairs(r) == [(1, "3", "-1.0")]


def test_custom_sql_error_is_reported(spark):
    r = run(spark, customers(spark), [mapping(1, "score", '{"custom_sql": "SELECT nope FROM dfSQL"}')])
    assert r.rule_errors.count() == 1 and r.detailed.count() == 0


def test_registered_python_check(spark):
    sqlrules.register_python_check("negative_scores", lambda df: df.where(F.col("score") < 0))
    r = run(spark, customers(spark), [mapping(1, "score", '{"custom_python": "negative_scores"}')])
    assert pairs(r) == [(1, "3", "-1.0")]


def test_business_rule_window_tokens_and_view_names(spark):
    orders(spark).createOrReplaceTempView("sales_orders")
    customers(spark).createOrReplaceTempView("sales_customers")
    sql = ("WITH known AS (SELECT DISTINCT customer_id AS id FROM `proj.sales.customers`) "
           "SELECT order_id, customer_id FROM `proj.sales.orders` WHERE customer_id NOT IN (SELECT id FROM known WHERE id IS NOT NULL) "
           "AND order_date BETWEEN '{val_st_dt}' AND '{val_end_dt}' ;")
    m = mapping(1, "order_id, customer_id", sql, test_type="Business", pk="order_id")
    r = validate(spark, ObjectRun(2, "orders", "order_id", orders(spark), [m], CLOCK,
                                  window=(dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 3))))
    assert pairs(r) == [(1, "12", "12, 9")]


def test_render_keeps_braces_and_strips_semicolon():
    sql = sqlrules.render_business_sql("SELECT * FROM `p.d.t` WHERE x RLIKE '^[0-9]{3}$' AND d >= '{val_st_dt}';",
                                       dt.datetime(2024, 1, 1), None)
    assert sql == "SELECT * FROM d_t WHERE x RLIKE '^[0-9]{3}$' AND d >= '2024-01-01 00:00:00'"


def test_type_conformance_and_declared_not_null(spark):
    declared = [("customer_id", "INT64", "NO"), ("score", "INT64", "YES"), ("signup", "DATE", "YES"),
                ("email", "BOOL", "NO")]
    r = run(spark, customers(spark), [mapping(1, "", "{}")], declared=declared)
    got = pairs(r)
    assert (1, "score detected as double type. Schema specifies INT64 type.", "score") in got
    assert (1, None, None) in got and (1, "3", None) in got  # NULL id and NULL email rows
    assert len(got) == 3


def test_schema_rule_without_declared_schema_is_an_error(spark):
    r = run(spark, customers(spark), [mapping(1, "customer_id", "{}")])
    assert r.rule_errors.count() == 1


def test_summary_counts_percent_and_tiers(spark):
    th = spark.createDataFrame([(1, 1, 0.0, 3, 1), (2, 2, 0.1, 1, 1), (3, 2, 0.3, 2, 1), (4, 2, 0.3, 3, 1),
                                (5, 3, 0.0, 3, 1), (6, 2, 0.01, 3, 0)],
                               "Threshold_ID int, Mapping_ID int, Failure_Threshold_Value double, "
                               "Criticality int, Active int")
    ms = [mapping(1, "email", '{"is_nullable": "NO"}'), mapping(2, "name", '{"max_length": 2}'),
          mapping(3, "status", '{"allowed": ["Active", "Pending", "Closed", "Deleted"]}')]
    r = run(spark, customers(spark), ms, thresholds=th)
    got = {x["Mapping_ID"]: (x["Failure_Count"], round(x["Failure_Percent"], 4), x["Criticality"])
           for x in r.aggregated.collect()}
    assert got[1] == (1, round(1 / 6, 4), 3)
    assert got[2] == (3, 0.5, 3)          # tie on 0.3 resolves to the higher tier; inactive ignored
    assert got[3] == (0, 0.0, None)       # tier 0.0 needs at least one failure


def test_detailed_rows_per_mapping_equal_failure_count(spark):
    ms = [mapping(1, "score", '{"min": 0, "max": 50}'), mapping(2, "customer_id", '{"distinct": true}'),
          mapping(3, "email", '{"regex": "@"}')]
    r = run(spark, customers(spark), ms)
    detail = {x["Mapping_ID"]: x["count"] for x in r.detailed.groupBy("Mapping_ID").count().collect()}
    agg = {x["Mapping_ID"]: x["Failure_Count"] for x in r.aggregated.collect()}
    assert all(detail.get(k, 0) == v for k, v in agg.items()) and set(agg) == {1, 2, 3}


def test_fused_equals_union_of_single_rules(spark):
    logics = ['{"min": 0}', '{"max": 50}', '{"min_length": 3}', '{"allowed": ["Active"]}']
    cols = ["score", "score", "name", "status"]
    ms = [mapping(i + 1, c, logic) for i, (c, logic) in enumerate(zip(cols, logics))]
    fused = pairs(run(spark, customers(spark), ms))
    single = sorted((p for m in ms for p in pairs(run(spark, customers(spark), [m]))),
                    key=lambda t: tuple("" if v is None else str(v) for v in t))
    assert fused == single


def test_failing_and_passing_partition_the_input(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    ms = [mapping(1, "o_totalprice", '{"max": 300000}', pk="o_orderkey"),
          mapping(2, "o_custkey", '{"distinct": true}', pk="o_orderkey")]
    r = run(spark, df, ms, pk="o_orderkey")
    failing = {x[0] for x in r.detailed.select("Primary_Key_Value_s_").distinct().collect()}
    passing = {str(x[0]) for x in passing_rows(df, r).select("o_orderkey").collect()}
    every = {str(x[0]) for x in df.select("o_orderkey").collect()}
    assert failing | passing == every and not failing & passing


def test_row_rules_share_one_scan(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    ms = [mapping(i, c, logic, pk="o_orderkey") for i, (c, logic) in enumerate(
        [("o_totalprice", '{"max": 1}'), ("o_orderpriority", '{"allowed": ["x"]}'),
         ("o_orderdate", '{"min_date": "1996-01-01"}'), ("o_orderstatus", '{"regex": "^[FOP]$"}')], 1)]
    r = run(spark, df, ms, pk="o_orderkey")
    plan = r.detailed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1
    counts_plan = r.counts._jdf.queryExecution().executedPlan().toString()
    assert counts_plan.count("Scan parquet") + counts_plan.count("FileScan parquet") <= 2


def test_lookup_side_is_broadcast_when_small(spark):
    df = spark.read.parquet(f"{SF001}/customer.parquet")
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    logic = '{"allowed": {"table_name": "nation", "column_name": "n_nationkey"}}'
    r = run(spark, df, [mapping(1, "c_nationkey", logic, pk="c_custkey")], pk="c_custkey",
            tables={"nation": nation})
    r.detailed.collect()
    plan = r.detailed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_hot_and_cold_duplicate_keys_match_brute_force(spark):
    from tessera.operators import keys
    rows = [(1, i) for i in range(300)] + [(k, i) for k in range(2, 40) for i in range(k % 4 + 1)] + [(None, 0)]
    df = spark.createDataFrame(rows, "k int, id int")
    got = keys.duplicate_rows(df, ["k"])
    expected = sorted((k, i) for k, i in rows if k is not None and sum(1 for x, _ in rows if x == k) > 1)
    assert sorted((r["k"], r["id"]) for r in got.collect()) == expected
    text = df.selectExpr("CAST(k AS STRING) AS k", "id")
    assert sorted((int(r["k"]), r["id"]) for r in keys.duplicate_rows(text, ["k"]).collect()) == expected
    assert keys.duplicate_keys(text, ["k"]).schema["_key0"].dataType.simpleString() == "binary"  # a digest, not the text
    unique = keys.rows_without_duplicates(df, ["k"], df).collect()
    assert sorted(rows, key=str) == sorted([(r["k"], r["id"]) for r in unique] + expected, key=str)


def test_invalid_regex_is_reported_and_other_rules_still_run(spark):
    ms = [mapping(1, "email", '{"regex": "[a-"}'), mapping(2, "score", '{"min": 0}')]
    r = run(spark, customers(spark), ms)
    errs = r.rule_errors.collect()
    assert [(e["Mapping_ID"], e["Test_Key"]) for e in errs] == [(1, "regex")] and "invalid regex" in errs[0]["Error"]
    assert pairs(r) == [(2, "3", "-1.0")]


def test_lookup_hot_and_cold_values_match_brute_force(spark):
    from pyspark.sql import types as T

    from tessera.operators import lookups
    rows = [(i, 1) for i in range(200)] + [(1000 + i, i % 30) for i in range(90)] + [(5000, None)]
    df = spark.createDataFrame(rows, "id int, v int")
    ref = spark.createDataFrame([(x,) for x in range(0, 30, 2)], "w int")  # 1 is not in the lookup
    spec = {"table_name": "ref", "column_name": "w"}
    for forbidden in (False, True):
        got = lookups.lookup_failures(df, "v", T.IntegerType(), spec, forbidden, ["id"], {"ref": ref})
        inside = {x for x in range(0, 30, 2)}
        expected = sorted(i for i, v in rows if v is not None and ((v in inside) == forbidden))
        assert sorted(int(r[0]) for r in got.collect()) == expected


def test_missing_primary_key_column_is_an_object_error(spark):
    import pytest

    from tessera.operators.fused import MissingColumnError
    with pytest.raises(MissingColumnError):
        run(spark, customers(spark), [mapping(1, "score", '{"min": 0}')], pk="cust_no")


def test_empty_input_gives_zero_rates_and_no_tier(spark):
    th = spark.createDataFrame([(1, 1, 0.0, 3, 1)], "Threshold_ID int, Mapping_ID int, "
                                                    "Failure_Threshold_Value double, Criticality int, Active int")
    empty = customers(spark).where("1 = 0")
    ms = [mapping(1, "email", '{"is_nullable": "NO"}'), mapping(2, "customer_id", '{"distinct": true}')]
    r = run(spark, empty, ms, thresholds=th)
    assert r.detailed.count() == 0
    got = sorted((x["Mapping_ID"], x["Failure_Count"], x["Failure_Percent"], x["Criticality"])
                 for x in r.aggregated.collect())
    assert got == [(1, 0, 0.0, None), (2, 0, 0.0, None)]
    files = validate(spark, ObjectRun(1, "customers", "customer_id", empty, ms, CLOCK, emit_empty=False))
    assert files.aggregated.count() == 0  # file path: no aggregate for an empty file


def test_profile_file(spark, tmp_dir):
    import os

    from tessera.operators.profile import profile_file
    path = os.path.join(tmp_dir, "sample.csv")
    with open(path, "w") as f:
        f.write("id,email,joined\n1,a@x.com,2024-01-02\n2,b@y.org,2024-02-03\n3,,2024-03-04\n")
    got = {r["column_name"]: r for r in profile_file(spark, path).collect()}
    assert got["email"]["null_count"] == 1 and got["email"]["looks_like_email"] is True
    assert got["id"]["distinct_count"] == 3 and got["id"]["max_value"] == 3.0
    assert got["joined"]["looks_like_date"] is True


def test_many_checks_share_one_scan(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    ms = [mapping(i, "o_totalprice", '{"max": %d}' % (400_000 + 500 * i), pk="o_orderkey") for i in range(1, 201)]
    r = run(spark, df, ms, pk="o_orderkey")
    for frame in (r.detailed, r.counts):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("FileScan parquet", plan)) == 1
    counts = {x["Mapping_ID"]: x["Failure_Count"] for x in r.aggregated.collect()}
    prices = [x[0] for x in df.select("o_totalprice").collect()]
    assert all(counts[i] == sum(p > 400_000 + 500 * i for p in prices) for i in range(1, 201))


def test_row_filters_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    r = run(spark, df, [mapping(1, "o_totalprice", '{"max": 450000}', pk="o_orderkey")], pk="o_orderkey")
    plan = r.failures._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(o_totalprice,450000", plan)


def test_building_the_plan_runs_no_job(spark):
    df = spark.read.parquet(f"{SF001}/orders.parquet")
    nation = spark.read.parquet(f"{SF001}/nation.parquet")
    ms = [mapping(1, "o_orderkey", '{"distinct": true}', pk="o_orderkey"),
          mapping(2, "o_custkey", '{"forbidden": {"table_name": "nation", "column_name": "n_nationkey"}}', pk="o_orderkey"),
          mapping(3, "o_totalprice", '{"min": 0}', pk="o_orderkey")]
    spark.sparkContext.setJobGroup("plan only", "plan only")
    r = run(spark, df, ms, pk="o_orderkey", tables={"nation": nation})
    passing_rows(df, r)
    spark.sparkContext.setJobGroup("", "")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan only")


def test_passing_rows_judges_null_composite_and_repeated_keys(spark):
    rows = [(None, "x", 1), (None, "x", 2), ("a", "b, c", 3), ("a, b", "c", -4), ("a", "b, c", 5), ("z", None, 3), ("y", "q", 5), ("w", "w", 7)]
    df = spark.createDataFrame(rows, "k1 string, k2 string, v int")
    ms = [mapping(1, "v", '{"min": 0}', pk="k1, k2"), mapping(2, "v", '{"distinct": true}', pk="k1, k2")]
    got = passing_rows(df, run(spark, df, ms, pk="k1, k2")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, "x", 1), (None, "x", 2), ("w", "w", 7)], key=str)
    ref = spark.createDataFrame([(1,), (7,)], "w int")
    for kind, kept in (("allowed", {1, 7}), ("forbidden", {2, 3, -4, 5})):
        logic = '{"%s": {"table_name": "ref", "column_name": "w"}}' % kind
        got = passing_rows(df, run(spark, df, [mapping(1, "v", logic, pk="k1, k2")], pk="k1, k2", tables={"ref": ref})).collect()
        assert {r.v for r in got} == kept
    sql = "SELECT k1, k2, v FROM dfSQL WHERE v = 3"
    got = passing_rows(df, run(spark, df, [mapping(1, "v", '{"custom_sql": "%s"}' % sql, pk="k1, k2")], pk="k1, k2")).collect()
    assert sorted(r.v for r in got) == [-4, 1, 2, 5, 7]  # the repeated key (a, "b, c") is held back whole


def test_render_renames_tables_only():
    sql = sqlrules.render_business_sql(
        "SELECT o.`order.id` FROM `p.sales.orders` o\nJOIN  `p.sales.items` i ON o.`order.id` = i.id", None, None)
    assert sql == "SELECT o.`order.id` FROM sales_orders o\nJOIN  sales_items i ON o.`order.id` = i.id"
