"""Declared-schema conformance.

Type conformance compares the object's Spark schema with its declared schema:
metadata only, no scan. The declared schema is a short list (one row per
column), so it is read on the driver; findings become a small DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera import schemas
from tessera.functions.local import local_frame
from tessera.functions.typematrix import accepts, declared_parts, mismatch_message, missing_message


def declared_list(declared) -> list[tuple[str, str, str | None]]:
    """Accept a DataFrame ``(column, data_type, is_nullable)``, tuples or dicts."""
    if declared is None:
        return []
    if isinstance(declared, DataFrame):
        rows = declared.select("column", "data_type", "is_nullable").collect()
        return [(r["column"], r["data_type"], r["is_nullable"]) for r in rows]
    out = []
    for item in declared:
        if isinstance(item, dict):
            out.append((item["column"], item["data_type"], item.get("is_nullable")))
        else:
            col, dtype, *rest = item
            out.append((col, dtype, rest[0] if rest else None))
    return out


def restrict(declared: list[tuple], columns: tuple[str, ...] | list[str]) -> list[tuple]:
    """Declared schema inner-joined with the mapped columns (all when none named)."""
    if not columns:
        return declared
    wanted = {c.lower() for c in columns}
    return [d for d in declared if d[0].lower() in wanted]


def nested_findings(path: str, dtype: T.DataType, declared: str) -> list[tuple[str, str, str]]:
    """(path, ``wrong``/``missing``/``extra``, message) below a column whose declared type is a STRUCT or ARRAY, however
    deep; an array's element is ``path[]``. Empty where the declaration names no parts or the column is text."""
    parts = declared_parts(declared)
    if isinstance(dtype, T.ArrayType) and len(parts) == 1 and parts[0][0] == "":
        return _part_findings(f"{path}[]", dtype.elementType, parts[0][1])
    if not isinstance(dtype, T.StructType) or not parts or parts[0][0] == "":
        return []
    actual = {f.name.lower(): f for f in dtype.fields}
    found = []
    for name, kind in parts:
        if name.lower() in actual:
            found += _part_findings(f"{path}.{actual[name.lower()].name}", actual[name.lower()].dataType, kind)
        else:
            found.append((f"{path}.{name}", "missing", missing_message(f"{path}.{name}", kind)))
    known = {name.lower() for name, _ in parts}
    return found + [(f"{path}.{f.name}", "extra", f"{path}.{f.name} is not declared.") for f in dtype.fields if f.name.lower() not in known]


def _part_findings(path: str, dtype: T.DataType, declared: str) -> list[tuple[str, str, str]]:
    if accepts(declared, dtype.simpleString()) is False:
        return [(path, "wrong", mismatch_message(path, dtype.simpleString(), declared))]
    return nested_findings(path, dtype, declared)


def type_mismatches(df: DataFrame, declared: list[tuple], strict: bool = False) -> list[tuple[str, str]]:
    """(column, message) for every present column whose Spark type the declared type rejects. Below a
    column that fits as STRUCT or ARRAY, a row per part of a wrong type or missing, named by its path."""
    actual = {f.name.lower(): f for f in df.schema.fields}
    found = []
    for column, data_type, _ in declared:
        hit = actual.get(column.lower())
        if hit is None or data_type is None:
            continue
        kind = hit.dataType.simpleString()
        verdict = accepts(data_type, kind, strict=strict)
        if verdict is False:
            found.append((hit.name, mismatch_message(hit.name, kind, data_type)))
        elif not strict:
            found += [(path, message) for path, what, message in nested_findings(hit.name, hit.dataType, data_type) if what != "extra"]
    return found


def required_columns(declared: list[tuple]) -> list[str]:
    """Columns the declared schema marks NOT NULL."""
    return [c for c, _, nullable in declared if isinstance(nullable, str) and nullable.strip().upper() == "NO"]


def schema_diff(spark: SparkSession, df: DataFrame, declared: list[tuple], object_id: int) -> DataFrame:
    """Missing / extra columns and a column-count finding."""
    actual = {f.name.lower(): f.name for f in df.schema.fields}
    expected = {c.lower(): c for c, _, _ in declared}
    rows = [(object_id, expected[k], "missing", "declared but absent") for k in expected if k not in actual]
    rows += [(object_id, actual[k], "extra", "present but not declared") for k in actual if k not in expected]
    kinds = {f.name.lower(): f for f in df.schema.fields}
    details = {"missing": "declared but absent", "extra": "present but not declared"}
    rows += [(object_id, path, what, details[what]) for c, kind, _ in declared if kind and c.lower() in kinds
             for path, what, _ in nested_findings(kinds[c.lower()].name, kinds[c.lower()].dataType, kind) if what in details]
    if len(actual) != len(expected):
        rows.append((object_id, None, "column_count", f"{len(actual)} present, {len(expected)} declared"))
    return local_frame(spark, rows, schemas.SCHEMA_FINDINGS)


def declared_frame(spark: SparkSession, declared: list[tuple]) -> DataFrame:
    return local_frame(spark, declared, schemas.DECLARED_SCHEMA)
