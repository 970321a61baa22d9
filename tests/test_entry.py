"""Driver contract and proposal round trip."""

import json

import __spark_entry__ as entry
from tessera import schemas
from tessera.operators import profile as PR


def test_every_query_has_a_sql_twin():
    from tessera.plans import suite
    assert set(suite.all_queries()) <= set(entry.queries())
    assert set(suite.all_queries()) == set(suite.all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs_on_smallest_data(spark):
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == [f.name for f in schemas.DETAILED.fields]
    assert df.count() > 0


def test_allowed_proposal_keeps_values_with_separators(spark):
    df = spark.createDataFrame([("a, b",), ("c",), ("a, b",), ('q"x',)], "s string")
    logic = PR.candidate_rule_logic(PR.suggest_rules(df)).first()["rule_logic"]
    assert json.loads(logic)["allowed"] == ["a, b", "c", 'q"x']
