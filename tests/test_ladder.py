"""Threshold ladders give what the same bounds give one by one."""

import json
import random

import pytest

from tessera.functions.projection import quote_name
from tessera.operators import fused, ladder
from tessera.plans.engine import ObjectRun, passing_rows, validate
from tests.fixtures import CLOCK, mapping

SCHEMA = "id int, i bigint, d double, n decimal(12,3), t string, day date, at timestamp, wall timestamp_ntz, file string"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    data = []
    for k in range(300):
        v = rng.choice([None, rng.randint(-20, 20), rng.randint(-20, 20), 2 ** 53 + 1, -2 ** 40])
        x = rng.choice([None, float("nan"), float("inf"), rng.uniform(-3, 3), 0.0, -0.0, 2.5])
        t = rng.choice([None, "", "abc", "Zoé", "12", "-3.5", " 7", "é", "zzz" * 5, "2024-05-03"])
        day = rng.choice([None, f"2024-05-{rng.randint(1, 28):02d}"])
        data.append((k, v, x, rng.choice([None, "1.500", "-2.000", "99.125"]), t, day, day and day + " 06:00:00", f"f{k % 3}"))
    return spark.createDataFrame(data, "id int, i bigint, d double, n string, t string, day string, at string, file string").selectExpr(
        "id", "i", "d", "CAST(n AS decimal(12,3)) n", "t", "CAST(day AS date) day", "CAST(at AS timestamp) at",
        "CAST(at AS timestamp_ntz) wall", "file").cache()


BOUNDS = {
    ("i", "max"): [0, 3, 3, -5, 10, 2 ** 53, 5.5, 1e3, 2.5, -7.25, 2 ** 40], ("i", "min"): [0, 3, -5, 10, 2 ** 53, -2 ** 41],
    ("d", "max"): [0, 1, 2.5, -1.5, 1e9], ("d", "min"): [0, -0.0, 1, 2.5, 1.25], ("n", "max"): [1, 2, 1.5, 50, 98, 0.1, 1.75, 99.125, 99.2],
    ("t", "max"): ["abc", "b", "Zo", "é", "a"], ("t", "min"): ["0", 3, -4, 7, 11.5, "12"], ("t", "max_length"): [0, 1, 2, 3, 9],
    ("t", "min_length"): [1, 2, 3, 4], ("t", "max_date"): [f"2024-05-0{k}" for k in range(1, 6)],
    ("day", "min_date"): [f"2024-05-{k:02d}" for k in range(1, 29, 4)] + ["CURRENT_DATE"],
    ("at", "max_date"): [f"2024-05-{k:02d} 06:00:00" for k in range(1, 29, 4)] + [f"2024-05-{k:02d}" for k in range(1, 6)],
    ("wall", "min_date"): [f"2024-05-{k:02d} 06:00:00.5" for k in range(1, 29, 4)],
    ("day", "max"): ["2024-05-03", "2024-05-05", "2024-05-07", "2024-05-09"], ("i, d", "max"): [1, 2, 3, 4, 5],
}


def rules():
    out, mid = [], 100
    for (column, key), bounds in BOUNDS.items():
        for bound in bounds:
            out.append(mapping(mid, column, json.dumps({key: bound}), pk="id"))
            mid += 1
    return out + [mapping(1, "t", '{"allowed": ["abc"], "max_length": 2}', pk="id"), mapping(2, "t", '{"is_nullable": "NO"}', pk="id"),
                  mapping(3, "t, d", '{"is_nullable": "YES"}', pk="id")]


def results(spark, rows, least, monkeypatch, scope=None):
    monkeypatch.setattr(ladder, "LEAST_RUNGS", least)
    r = validate(spark, ObjectRun(1, "odd", "id", rows, rules(), CLOCK, scope=scope,
                                  scope_runs=[(f"f{i}", i + 1) for i in range(3)] if scope else []))
    assert not r.rule_errors.collect()
    found = (sorted(map(str, r.failures.collect())), sorted(map(str, r.counts.groupBy(*([fused.SCOPE] if scope else []), "Mapping_ID").agg(
        {"Failure_Count": "sum", "Row_Count": "max"}).collect())), sorted(x.id for x in passing_rows(rows, r).collect()))
    return r, found


@pytest.mark.parametrize("scope", [None, "file"])
def test_ladders_equal_single_conditions(spark, rows, monkeypatch, scope):
    single, expected = results(spark, rows, 10 ** 9, monkeypatch, scope)
    laddered, got = results(spark, rows, 2, monkeypatch, scope)
    assert len(expected[0]) > 1000 and got == expected
    ladders, alone = ladder.split(laddered.compiled)
    assert len(ladders) == 18 and {cc.check.mapping.column_name for cc in alone} == {"t", "day", "i, d"}


def test_counts_of_no_rows(spark, rows):
    r = validate(spark, ObjectRun(1, "odd", "id", rows.limit(0), rules(), CLOCK))
    assert {(x.Failure_Count, x.Row_Count) for x in r.counts.collect()} == {(0, 0)}


def test_one_comparison_reaches_the_scan(spark, tmp_dir):
    spark.range(10).selectExpr("id", "CAST(id AS double) v").write.parquet(f"{tmp_dir}/t")
    ms = [mapping(i, "v", json.dumps({"max": 1000 - i}), pk="id") for i in range(1, 201)]
    r = validate(spark, ObjectRun(1, "t", "id", spark.read.parquet(f"{tmp_dir}/t"), ms, CLOCK))
    plan = r.failures._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,800.0)]" in plan
    assert plan.count("FileScan") == 1 and r.detailed.count() == 0


def test_patterns_of_date_formats_are_told_apart(spark):
    df = spark.createDataFrame([(1, "03-04-2024")], "id int, t string")
    ms = [mapping(10 * k + i, "t", json.dumps({"max_date": [f"2024-0{i}-20", fmt]}), pk="id")
          for k, fmt in enumerate(["dd-MM-yyyy", "MM-dd-yyyy"]) for i in range(1, 6)]
    r = validate(spark, ObjectRun(1, "t", "id", df, ms, CLOCK))
    assert sorted(x.Mapping_ID for x in r.detailed.collect()) == [1, 2, 3, 11, 12]
    assert quote_name("t") in ladder.split(r.compiled)[0][0].rungs[0].lhs
