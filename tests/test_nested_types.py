"""Declared STRUCT and ARRAY types compared part by part."""

import pytest

from tessera.functions.typematrix import declared_parts
from tessera.operators.schema_check import schema_diff, type_mismatches


@pytest.mark.parametrize("declared, parts", [
    ("INT64", []), ("ARRAY<INT64>", [("", "INT64")]), ("STRUCT<a INT64, b ARRAY<STRUCT<c STRING, d NUMERIC(10, 2)>>>",
                                                       [("a", "INT64"), ("b", "ARRAY<STRUCT<c STRING, d NUMERIC(10, 2)>>")]),
    ("struct< a INT64 >", [("a", "INT64")]), ("STRUCT<a>", []), ("STRUCT<a INT64", []), ("STRUCT<a INT64>>", []), ("ARRAY<>", []),
    ("ARRAY<INT64, STRING>", []), ("NUMERIC(10, 2)", [])])
def test_declared_parts(declared, parts):
    assert declared_parts(declared) == parts


def test_findings_are_named_by_path(spark):
    df = spark.createDataFrame([], "id int, s struct<a: int, `B`: array<struct<c: date, extra: int>>, t: string>, plain array<int>, text string")
    declared = [("s", "STRUCT<a BOOL, b ARRAY<STRUCT<c INT64, gone DATE>>, t STRUCT<x INT64>>", "YES"), ("plain", "ARRAY<DATE>", "YES"),
                ("text", "STRUCT<x INT64>", "YES"), ("id", "INT64", "NO")]
    assert [c for c, _ in type_mismatches(df, declared)] == ["s.a", "s.B[].c", "s.B[].gone", "plain[]"]
    messages = dict(type_mismatches(df, declared))
    assert messages["s.a"] == "s.a detected as int type. Schema specifies BOOL type."
    assert messages["s.B[].gone"] == "s.B[].gone is missing. Schema specifies DATE type."
    found = {(r.Column_Name, r.Finding) for r in schema_diff(spark, df, declared, 1).collect()}
    assert found == {("s.B[].gone", "missing"), ("s.B[].extra", "extra")}
    assert type_mismatches(df, [("s", "STRUCT", "YES"), ("plain", "ARRAY", "YES")]) == []
