"""Property tests: fused = union of single rules; detailed rows per
mapping = Failure_Count; failing and passing rows partition the input."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tessera.plans.engine import ObjectRun, passing_rows, validate
from tests.fixtures import CLOCK, mapping

ROWS = st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(-5, 5)),
                          st.one_of(st.none(), st.sampled_from(["a", "bb", "ccc", "x@y.z"]))),
                min_size=0, max_size=25)
RULES = [("v", '{"min": 0}'), ("v", '{"max": 3, "is_nullable": "NO"}'), ("s", '{"allowed": ["a", "bb"]}'),
         ("s", '{"regex": "@"}'), ("s", '{"min_length": 2, "max_length": 2}'), ("id", '{"distinct": true}'),
         ("v", '{"forbidden": [1, 2]}')]


def _key(t):
    return tuple("" if v is None else str(v) for v in t)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(rows=ROWS, chosen=st.sets(st.integers(0, len(RULES) - 1), min_size=1, max_size=4))
def test_fused_matches_single_rules_and_counts(spark, rows, chosen):
    rows = [(n,) + r for n, r in enumerate(rows)]  # a unique primary key per row
    df = spark.createDataFrame(rows, "pk int, id int, v int, s string")
    ms = [mapping(i + 1, RULES[i][0], RULES[i][1], pk="pk") for i in sorted(chosen)]
    fused = validate(spark, ObjectRun(1, "t", "pk", df, ms, CLOCK))
    got = sorted(((r["Mapping_ID"], r["Primary_Key_Value_s_"], r["Actual_Value"])
                  for r in fused.detailed.collect()), key=_key)
    single = sorted((t for m in ms for t in (
        (r["Mapping_ID"], r["Primary_Key_Value_s_"], r["Actual_Value"])
        for r in validate(spark, ObjectRun(1, "t", "pk", df, [m], CLOCK)).detailed.collect())), key=_key)
    assert got == single
    counts = {r["Mapping_ID"]: r["Failure_Count"] for r in fused.aggregated.collect()}
    for m in ms:
        assert counts[m.mapping_id] == sum(1 for t in got if t[0] == m.mapping_id)
    failing = {t[1] for t in got}
    passing = [r["pk"] for r in passing_rows(df, fused).collect()]
    assert all(str(p) not in failing for p in passing)
    assert len(passing) + sum(1 for r in rows if str(r[0]) in failing) == len(rows)
