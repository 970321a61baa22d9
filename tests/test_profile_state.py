"""Least values, sketches and mergeable profiles (F4, F5), and proposals for long texts."""

import datetime as dt
import json
import random
from decimal import Decimal

import pytest

from tessera.operators import profile as PR

SCHEMA = ("k int, b boolean, x double, f float, n decimal(10,2), t string, long string, day date, at timestamp, wall timestamp_ntz, "
          "none string, `od.d` array<int>")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(900):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 40))
        out.append((rng.choice([None, rng.randint(-50, 50)]), rng.choice([True, False, None]),
                    rng.choice([None, float("nan"), -0.0, 0.0, rng.randint(0, 9) / 4, float("-inf")]), rng.choice([None, 0.1, 2.5]),
                    rng.choice([None, Decimal(rng.randint(-300, 300)) / 100]), rng.choice([None, "", "ä", "Z", "a", f"w{rng.randint(0, 99)}"]),
                    "x" * 200 + str(rng.randint(0, 20)), day, dt.datetime(2024, 1, 1, rng.randint(0, 23)), dt.datetime(2024, 1, 1, rng.randint(0, 3), 0, 1),
                    None, [rng.randint(0, 3)]))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def expected_least(spark, frame, n):
    """By a sort of all distinct values."""
    out = {}
    for i, f in enumerate(frame.schema.fields):
        slots = PR._slots(f)
        every = frame.where(f"`{f.name}` IS NOT NULL").select(*[c.alias(k) for k, c in slots.items()]).distinct()
        out[i] = [tuple(r) for r in every.orderBy(*slots).limit(n).collect()]
    return {k: v for k, v in out.items() if v}


@pytest.mark.parametrize("n", [1, 5, 400])
def test_least_values_equal_a_full_sort(spark, frame, n):
    got = {}
    for r in sorted(PR._least(frame, n).collect(), key=lambda r: (r.ordinal, r.sample_rank)):
        got.setdefault(r.ordinal, []).append(tuple(r[s] for s in PR._slots(frame.schema.fields[r.ordinal])))
    assert str(got) == str(expected_least(spark, frame, n))  # as text: NaN equals NaN


def test_small_batches_keep_the_bound(spark, frame):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_least_values_equal_a_full_sort(spark, frame, 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def as_text(profile):
    return sorted(str(r.asDict()) for r in profile.collect())


def test_sketched_profile_equals_exact_for_few_values(frame):
    assert as_text(PR.profile(frame, approx=True)) == as_text(PR.profile(frame))


def test_merged_windows_equal_one_pass(spark, frame, tmp_dir):
    parts = [frame.where("day < '2024-01-10'"), frame.where("day >= '2024-01-10' AND day < '2024-02-01'"), frame.where("day >= '2024-02-01'"),
             frame.where("false")]
    for i, part in enumerate(parts):
        PR.profile_state(part).write.parquet(f"{tmp_dir}/window={i}")
    states = spark.read.parquet(tmp_dir).drop("window")
    assert as_text(PR.profile_of(PR.merge_states(states), frame)) == as_text(PR.profile(frame, approx=True))


def test_sketches_of_many_values_merge_to_the_same_estimate(spark):
    many = spark.range(60_000).selectExpr("id * 7919 AS a", "CAST(id AS string) AS s")
    whole = PR.profile(many, approx=True).select("column_name", "distinct_count").collect()
    merged = PR.merge_states([PR.profile_state(many.where(f"a % 3 = {k}")) for k in range(3)])
    assert sorted(PR.profile_of(merged, many).select("column_name", "distinct_count").collect()) == sorted(whole)
    assert all(abs(r.distinct_count - 60_000) < 0.06 * 60_000 for r in whole)


def test_sketched_profile_shuffles_no_values(spark, frame):
    plan = PR.profile(frame, approx=True)._jdf.queryExecution().executedPlan().toString()
    assert "distinct_count" in plan and "keys=[ordinal#" in plan
    assert not any("a#" in line and "hashpartitioning" in line for line in plan.splitlines())


def test_few_long_values_are_proposed_whole(spark):
    texts = ["y" * 300 + c for c in "cab"]
    df = spark.createDataFrame([(i, texts[i % 3], "z" * 300 + str(i)) for i in range(40)], "id int, t string, many string")
    found = {(r.column_name, r.test_key): r.test_value for r in PR.suggest_rules(df).collect()}
    assert json.loads(found["t", "allowed"]) == sorted(texts)
    assert ("many", "allowed") not in found and found["many", "max_length"] == "302"
