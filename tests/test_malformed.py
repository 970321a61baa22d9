"""Malformed CSV and JSON records become findings, the others are judged."""

import datetime as dt
import os

import pytest

from tessera.clock import RunClock
from tessera.plans.catalog import Catalog, group_plan, rule_plan
from tessera.sources import readers
from tessera.streaming import arrivals

QUOTE = chr(34)
SCHEMA = "id int, name string, v double"
CSV = '1,ann,2.5\n2,bo\n3,"quo""ted, x",-1\n4,cy,1,9\nfive,di,1\n6,,\n7,ed,abc\n'
JSON = '{"id": 1, "name": "ann", "v": 2.5}\n{"id": 2, "name": \n{"id": 3, "extra": 1, "v": -1}\nnot json\n{"id": "x", "v": 1}\n'


@pytest.mark.parametrize("extension, text, good, bad, first", [
    ("csv", CSV, [(1, "ann", 2.5), (3, 'quo"ted, x', -1.0), (6, None, None)], 4, "2,bo"),
    ("json", JSON, [(1, "ann", 2.5), (3, None, -1.0)], 3, "not json")])
def test_findings_name_file_number_and_first_record(spark, tmp_dir, extension, text, good, bad, first):
    with open(f"{tmp_dir}/t.{extension}", "w") as f:
        f.write(text)
    with open(f"{tmp_dir}/clean.{extension}", "w") as f:
        f.write(text.split("\n")[0] + "\n")
    schema = spark.createDataFrame([], SCHEMA).schema
    rows, findings = readers.read_with_findings(spark, tmp_dir, extension, schema, 5)
    assert rows.columns == schema.fieldNames()
    assert sorted(map(tuple, rows.collect())) == sorted([*good, good[0]])
    found = findings.collect()
    assert [(r.Object_ID, r.Column_Name, r.Finding) for r in found] == [(5, None, "malformed")]
    assert found[0].Detail.startswith(f"t.{extension}: {bad} record(s), first: ") and (extension == "json" or first in found[0].Detail)


def test_other_formats_are_refused(spark, tmp_dir):
    with pytest.raises(ValueError):
        readers.read_with_findings(spark, tmp_dir, "xml", spark.createDataFrame([], SCHEMA).schema, 1)


@pytest.mark.parametrize("fmt, text", [("csv", CSV), ("json", JSON)])
def test_arriving_files(spark, tmp_dir, fmt, text):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/t.{fmt}", "w") as f:
        f.write(text)
    cat = Catalog.from_rows(spark, rule=[(1, "not negative", '{"min": 0}', "Custodial")],
                            object_lookup=[(1, "t", "db", fmt, "id", "full table", None, None, 1)],
                            rule_mapping=[(1, 1, 1, "v", None, None, "Custodial", 1)], rule_threshold=[(1, 1, 0.0, 1, 1)])
    arrivals.start(spark, landing, fmt, spark.createDataFrame([], SCHEMA).schema, group_plan(rule_plan(cat).collect()), cat.object_lookup,
                   f"{tmp_dir}/out", f"{tmp_dir}/ckpt", clock_fn=lambda: RunClock(dt.datetime(2024, 1, 1)), options={"escape": QUOTE} if fmt == "csv" else {}).awaitTermination(120)
    read = lambda name: spark.read.parquet(f"{tmp_dir}/out/{name}").collect()
    assert [(r.Primary_Key_Value_s_, r.Actual_Value) for r in read("detailed")] == [("3", "-1.0")]
    rows = {"csv": 3, "json": 2}[fmt]
    assert [(r.Failure_Count, round(r.Failure_Percent, 6)) for r in read("aggregated")] == [(1, round(1 / rows, 6))]
    found = read("schema_findings")
    assert [(r.Object_ID, r.Finding) for r in found] == [(1, "malformed")] and found[0].Source_File.endswith(f"t.{fmt}")
    assert {r.Val_Status for r in read("execution")} == {"Executing", "Success"}
