"""Lookup membership (P10, P12): allowed / forbidden values held in another table.

The lookup column is reduced to its distinct non-null values (A11) and joined,
never pulled to the driver: ``allowed`` keeps rows with no match (left anti),
``forbidden`` rows with a match (left semi). Values without fixed width are
compared by digest (see ``keys``). The join carries no hint: Spark broadcasts the
values where their bytes allow it, and otherwise shuffles by value and splits the
large partitions of a hot value over several tasks. Nothing runs while the plan
is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.projection import joined_text
from tessera.operators.fused import ACTUAL, PK_VALUE, scope_columns
from tessera.operators.keys import fixed_width


class LookupError_(ValueError):
    pass


def view_name(qualified: str) -> str:
    """``project.dataset.table`` -> ``dataset_table``; ``dataset.table`` -> ``dataset_table``."""
    parts = [p for p in qualified.replace("`", "").split(".") if p]
    return "_".join(parts[-2:]) if len(parts) > 1 else (parts[0] if parts else qualified)


def resolve_table(spark: SparkSession, spec: dict, tables: dict[str, DataFrame] | None) -> DataFrame:
    name = spec.get("table_name") or spec.get("table")
    if not name:
        raise LookupError_("lookup needs 'table_name'")
    dataset = spec.get("dataset_id") or spec.get("dataset")
    candidates = [f"{dataset}.{name}" if dataset else None, name,
                  view_name(f"{dataset}.{name}") if dataset else None]
    for key in [c for c in candidates if c]:
        if tables and key in tables:
            return tables[key]
    for key in [c for c in candidates if c]:
        if spark.catalog.tableExists(view_name(key)):
            return spark.table(view_name(key))
    raise LookupError_(f"lookup table {name!r} is not registered")


def lookup_values(spark: SparkSession, spec: dict, dtype: T.DataType,
                  tables: dict[str, DataFrame] | None) -> DataFrame:
    column = spec.get("column_name") or spec.get("column")
    if not column:
        raise LookupError_("lookup needs 'column_name'")
    table = resolve_table(spark, spec, tables)
    value = F.col(column).try_cast(dtype)
    return table.where(value.isNotNull()).select(fixed_width(value, dtype).alias("_lookup_value")).distinct()


def failing_rows(df: DataFrame, column: str, dtype: T.DataType, spec: dict, forbidden: bool,
                 tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows whose non-null value is not in the lookup (``forbidden``: is in it)."""
    values = lookup_values(df.sparkSession, spec, dtype, tables)
    rows = df.where(F.col(column).isNotNull())
    return rows.join(values, fixed_width(F.col(column), dtype) == values["_lookup_value"], "left_semi" if forbidden else "left_anti")


def passing_rows(df: DataFrame, column: str, dtype: T.DataType, spec: dict, forbidden: bool,
                 tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """The complement of ``failing_rows``: NULL values pass."""
    values = lookup_values(df.sparkSession, spec, dtype, tables)
    same = fixed_width(F.col(column), dtype) == values["_lookup_value"]
    if forbidden:
        return df.join(values, same, "left_anti")
    # Lookup values are distinct, so no row is repeated.
    met = df.join(values, same, "left").where(F.col(column).isNull() | F.col("_lookup_value").isNotNull())
    return met.select(*[df[c] for c in df.columns])


def lookup_failures(df: DataFrame, column: str, dtype: T.DataType, spec: dict, forbidden: bool,
                    pk_cols: list[str], tables: dict[str, DataFrame] | None = None, scope: str | None = None) -> DataFrame:
    rows = df.select(*dict.fromkeys(pk_cols + [column] + ([scope] if scope else [])))
    hits = failing_rows(rows, column, dtype, spec, forbidden, tables)
    return hits.select(joined_text(pk_cols).alias(PK_VALUE), joined_text([column]).alias(ACTUAL), *scope_columns(scope))
