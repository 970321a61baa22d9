"""Proposals from the data: composite keys, lookups, patterns."""

import json
import random
import re
from itertools import combinations

import pytest

from tessera.operators import discovery
from tessera.plans.engine import ObjectRun, validate
from tests.fixtures import CLOCK, mapping


def brute_keys(rows, names, max_size=3):
    found = []
    for size in range(1, max_size + 1):
        for combo in combinations(range(len(names)), size):
            values = [tuple(r[i] for i in combo) for r in rows]
            if not any(None in v for v in values) and len(set(values)) == len(rows) and not any(set(k) <= set(combo) for k in found):
                found.append(combo)
    return [tuple(names[i] for i in k) for k in found]


def test_minimal_keys_only(spark):
    rng = random.Random(1)
    rows = [(i // 7, i % 7, f"t{rng.randint(0, 3)}", i // 2, i % 2, rng.random(), None if i == 5 else i) for i in range(700)]
    df = spark.createDataFrame(rows, "a int, b int, c string, d int, e smallint, x double, holes int")
    expected = brute_keys([(*r[:5], r[6]) for r in rows], ["a", "b", "c", "d", "e", "holes"])
    assert {("a", "b"), ("d", "e")} <= set(expected) and discovery.composite_keys(df) == expected
    assert discovery.composite_keys(df, max_size=1) == []
    assert discovery.composite_keys(df, columns=["a", "c"]) == []
    assert discovery.composite_keys(df.withColumn("id", df.holes * 0 + df.d * 2 + df.e), columns=["id", "d", "e"]) == [("d", "e")]  # id has a hole
    assert discovery.composite_keys(df.limit(0)) == []
    three = spark.createDataFrame([(x, y, z) for x in "abc" for y in range(12) for z in range(11)], "x string, y int, z int")
    assert discovery.composite_keys(three) == [("x", "y", "z")] and discovery.composite_keys(three, max_size=2) == []
    assert discovery.composite_keys(three.unionByName(three.limit(1))) == []


def test_nearly_unique_combinations_are_checked_exactly(spark):
    many = spark.range(30_000).selectExpr("CAST(id / 100 AS int) a", "CAST(id % 100 AS int) b")
    assert discovery.composite_keys(many) == [("a", "b")]
    assert discovery.composite_keys(many.unionByName(many.where("a = 7 AND b = 9"))) == []


def test_what_a_few_repeats_rule_out_is_not_grouped_whole(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i // 200, i % 200, *(rng.randrange(700) for _ in range(4))) for i in range(20_000)]
    names = ["x", "y", "a", "b", "c", "d"]
    df = spark.createDataFrame(rows, names)
    grouped, group_by = [], type(df).groupBy
    monkeypatch.setattr(type(df), "groupBy", lambda self, *cols: grouped.append(self) or group_by(self, *cols))
    assert discovery.composite_keys(df, max_size=2) == brute_keys(rows, names, 2) == [("x", "y")]
    monkeypatch.undo()
    digests = [f for f in grouped if {"e", "combo"} & set(f.columns)]
    assert digests and sum(f.count() for f in digests) < 2 * len(rows)  # of the six near-unique pairs a share only


def test_one_repeat_is_found_wherever_its_digest_lies(spark):
    rng = random.Random(8)
    rows = [(i, i + 1, i // 50, i % 50, rng.randrange(3000)) for i in range(2_000)]
    names = ["i", "j", "x", "y", "a"]
    schema = "i int, j int, x int, y int, a int"
    assert discovery.composite_keys(spark.createDataFrame(rows, schema)) == brute_keys(rows, names)
    for at in range(5):  # one value of j, and one pair of x and y, come twice; i stays a key
        more = [*rows, (5_000 + at, rows[at][1], rows[9 * at][2], rows[9 * at][3], 4_000)]
        found = discovery.composite_keys(spark.createDataFrame(more, schema))
        assert found == brute_keys(more, names) and ("i",) in found and ("j",) not in found and ("x", "y") not in found


def test_lookups_are_exact_and_point_at_keys(spark):
    tables = {"items": spark.createDataFrame([(i, f"n{i % 40}", i % 90, "x" if i % 3 else None, 5) for i in range(500)],
                                             "item int, name string, shop long, tag string, one int"),
              "shops": spark.createDataFrame([(i, f"n{i}", i // 2) for i in range(100)], "shop int, name string, half int"),
              "tags": spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "tag string, no int")}
    found = {tuple(r)[:4] for r in discovery.lookup_rules(spark, tables).collect()}
    assert ("items", "shop", "shops", "shop") in found and ("items", "name", "shops", "name") in found
    assert ("shops", "half", "items", "item") in found and ("items", "shop", "shops", "half") not in found  # no key
    assert not any(c == "tag" for _, c, *_ in found)   # a lookup with a NULL is no key; one value proposes nothing
    assert not any(c == "one" for _, c, *_ in found)
    coverage = {tuple(r)[:4]: r.coverage for r in discovery.lookup_rules(spark, tables).collect()}
    assert coverage["items", "shop", "shops", "shop"] == pytest.approx(0.9)
    one_off = tables | {"items": tables["items"].unionByName(spark.createDataFrame([(1, "n1", 50_000, None, 5)], tables["items"].schema))}
    assert ("items", "shop", "shops", "shop") not in {tuple(r)[:4] for r in discovery.lookup_rules(spark, one_off).collect()}
    assert discovery.lookup_rules(spark, {}).count() == 0


def test_large_inclusions_survive_the_sketches(spark):
    tables = {"fact": spark.range(0, 60_000, 3).selectExpr("CAST(id AS int) ref"), "dim": spark.range(60_000).selectExpr("id AS key")}
    assert [tuple(r)[:4] for r in discovery.lookup_rules(spark, tables).collect()] == [("fact", "ref", "dim", "key")]
    rules = discovery.lookup_rule_logic(discovery.lookup_rules(spark, tables), "ref")
    assert json.loads(rules[0][2]) == {"allowed": {"dataset_id": "ref", "table_name": "dim", "column_name": "key"}}
    tables["dim"] = tables["dim"].where("key <> 30000")
    assert discovery.lookup_rules(spark, tables).count() == 0


def test_patterns_hold_for_every_value_and_serve_as_rules(spark):
    rng = random.Random(4)
    rows = [(i, f"Ab-{i:04d}", rng.choice(["x_1", "yy 22", None]), "".join(rng.choice("ab1 -.") for _ in range(12)), "é" * (1 + i % 3) + "z", "q" * (60 + i),
             "(a|b)*") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, code string, two string, noise string, other string, long string, marks string")
    found = {r.column_name: r.regex for r in discovery.patterns(df).collect()}
    assert found == {"code": r"^[A-Z][a-z]\-[0-9]{4}$", "two": r"^([a-z]{2} [0-9]{2}|[a-z]\_[0-9])$", "other": r"^[^\x00-\x7F]{1,3}[a-z]$",
                     "marks": r"^\([a-z]\|[a-z]\)\*$"}
    for column, regex in found.items():
        assert all(r[column] is None or re.search(regex, r[column]) for r in df.collect())
        result = validate(spark, ObjectRun(1, "t", "id", df, [mapping(1, column, json.dumps({"regex": regex}), pk="id")], CLOCK))
        assert result.detailed.count() == 0 and not result.rule_errors.collect()
    assert discovery.patterns(df.select("id")).count() == 0 and discovery.patterns(df.limit(0)).count() == 0
