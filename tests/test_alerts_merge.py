"""Alert routing (N1, N2, J7, J8) and catalog merge."""

from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators import alerts, merge
from tests.catalog_fixture import seed_catalog

AGG = [  # Failure_Count, Mapping_ID, Rule_ID, Object_ID, Criticality
    (3, 1, 1, 1, 3), (0, 4, 5, 1, None), (7, 3, 3, 1, 2), (2, 21, 1, 5, 1), (1, 24, 1, 7, 3)]


def aggregated(spark):
    rows = [(None, 0.1, k, "c", m, r, o, None, 1, c, "obj", "desc") for k, m, r, o, c in AGG]
    return spark.createDataFrame(rows, schemas.AGGREGATED)


def test_alert_rows_equal_mode(spark):
    got = sorted((r["Object_ID"], r["Criticality"], r["Notification_Handler_Text"])
                 for r in alerts.alert_rows(aggregated(spark), seed_catalog(spark)).collect())
    assert got[0] == (1, 2, "look into it today")
    assert got[1] == (1, 3, "wake somebody")
    assert (5, 1, None) in got and (7, 3, None) in got and len(got) == 4  # no route: kept, no text


def test_alert_rows_min_mode_fans_out(spark):
    got = alerts.alert_rows(aggregated(spark), seed_catalog(spark), mode="min").where("Object_ID = 1")
    assert got.count() == 5  # criticality 2 -> routes 1, 2; criticality 3 -> routes 1, 2, 3


def test_recipients(spark):
    got = sorted((r["Object_ID"], r["Contact_email"]) for r in
                 alerts.recipients(aggregated(spark), seed_catalog(spark)).collect())
    assert got == [(1, "lead@data.invalid"), (1, "oncall@data.invalid")]


CANDIDATES = [  # rule_id_temp, test_type, column_name, description, logic, confidence, include
    ("r1", "Custodial", "member_no", "pk not null", "{'is_nullable': 'NO'}", 0.9, True),   # equal to mapping 2
    ("r2", "Custodial", "email", "email shape", '{"regex": "@"}', 0.8, True),
    ("r3", "Custodial", "amount", "bad key", '{"custom_spark": "x"}', 0.8, True),
    ("r4", "Business", "order_id", "orphans", "SELECT 1 AS order_id", 0.5, True),
    ("r5", "Custodial", "name", "too sure", '{"min_length": 2}', 1.5, True),
    ("r6", "Custodial", "status", "skip me", '{"allowed": ["A"]}', 0.5, False),
]
CAND_SCHEMA = ("rule_id_temp string, test_type string, column_name string, rule_description string, "
               "rule_logic string, confidence double, include boolean")


def test_admission_reasons(spark):
    got = {r["rule_id_temp"]: r["reject_reason"] for r in
           merge.admit(spark.createDataFrame(CANDIDATES, CAND_SCHEMA)).collect()}
    assert got["r3"] == "key outside the rule vocabulary" and got["r5"] == "confidence outside [0, 1]"
    assert got["r1"] is None and got["r2"] is None and got["r4"] is None


def test_merge_skips_equal_rules_and_numbers_new_ones(spark):
    cat = seed_catalog(spark)
    res = merge.merge(spark, cat, spark.createDataFrame(CANDIDATES, CAND_SCHEMA), "members", "library",
                      "member_no")
    assert [r[0] for r in res.skipped.select("rule_id_temp").collect()] == ["r1"]
    rules = sorted((r["Rule_ID"], r["Rule_Logic"]) for r in res.rules.collect())
    assert rules == [(15, '{"regex": "@"}'), (16, "SELECT 1 AS order_id")]
    maps = sorted((r["Mapping_ID"], r["Object_ID"], r["Rule_ID"]) for r in res.mappings.collect())
    assert maps == [(31, 1, 15), (32, 1, 16)]
    th = sorted((r["Mapping_ID"], float(r["Failure_Threshold_Value"]), r["Criticality"])
                for r in res.thresholds.collect())
    assert th == [(31, 0.01, 2), (32, 0.01, 2)]


def test_merge_is_idempotent(spark):
    cat = seed_catalog(spark)
    cands = spark.createDataFrame(CANDIDATES, CAND_SCHEMA)
    first = merge.merge(spark, cat, cands, "members", "library", "member_no")
    cat.rule = cat.rule.unionByName(first.rules)
    cat.rule_mapping = cat.rule_mapping.unionByName(first.mappings)
    again = merge.merge(spark, cat, cands, "members", "library", "member_no")
    assert again.rules.count() == 0 and again.skipped.count() == 3
    forced = merge.merge(spark, cat, cands, "members", "library", "member_no", force=True)
    assert forced.rules.count() == 3


def test_equal_rules_of_a_batch_count_once_and_append_closes_the_merge(spark):
    cat = seed_catalog(spark)
    rows = [("b", "Custodial", "score", "again", '{"max": 9, "min": 1}', 0.9, True),
            ("a", "Custodial", "score", "first", '{"min": 1, "max": 9}', 0.9, True),
            ("a", "Custodial", "score", "tie", '{"min": 2}', 0.9, True), ("a", "Custodial", "name", "tie", '{"min_length": 3}', 0.9, True)]
    cands = spark.createDataFrame(rows, CAND_SCHEMA)
    res = merge.merge(spark, cat, cands, "members", "library", "member_no")
    assert res.rules.count() == 3
    ids = lambda frame, *cs: sorted(tuple(r) for r in frame.select(*cs).collect())
    assert ids(res.rules, "Rule_ID") == ids(res.mappings, "Rule_ID")
    assert ids(res.mappings, "Mapping_ID") == ids(res.thresholds, "Mapping_ID")
    logic = {r["Rule_ID"]: r["Rule_Logic"] for r in res.rules.collect()}
    column = {r["Rule_ID"]: r["Column_Name"] for r in res.mappings.collect()}
    assert {(column[i], logic[i]) for i in logic} == {("score", '{"max": 9, "min": 1}'), ("score", '{"min": 2}'),
                                                      ("name", '{"min_length": 3}')}
    merged = merge.append(cat, res)
    again = merge.merge(spark, merged, cands, "members", "library", "member_no")
    assert again.rules.count() == 0 and merged.rule.count() == cat.rule.count() + 3
    assert merged.object_lookup.count() == cat.object_lookup.count()


def test_new_object_and_hard_threshold(spark):
    cat = seed_catalog(spark)
    cands = spark.createDataFrame([("a", "Custodial", "id", "d", '{"distinct": true}', 0.7, True)], CAND_SCHEMA)
    res = merge.merge(spark, cat, cands, "reservations", "library", "reservation_no")
    assert res.object_id.select("Object_ID").first()[0] == 9
    th = res.thresholds.first()
    assert (float(th["Failure_Threshold_Value"]), th["Criticality"]) == (0.0, 3)


def test_existing_primary_key_is_not_overwritten(spark):
    cat = seed_catalog(spark)
    chosen, conflicts = merge.resolve_object(spark, cat, "members", "library", "reader_no")
    assert chosen.select("Primary_Key").first()[0] == "member_no" and conflicts.count() == 1
    assert conflicts.select(F.col("_proposed")).first()[0] == "reader_no"


def test_alert_extracts_per_object(spark, tmp_dir):
    import os
    rows = alerts.alert_rows(aggregated(spark), seed_catalog(spark))
    alerts.write_extracts(rows, f"{tmp_dir}/extracts")
    parts = sorted(d for d in os.listdir(f"{tmp_dir}/extracts") if d.startswith("Object_ID="))
    assert parts == ["Object_ID=1", "Object_ID=5", "Object_ID=7"]
    back = spark.read.option("header", True).csv(f"{tmp_dir}/extracts")
    assert back.count() == rows.count()
