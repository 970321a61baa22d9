"""Uniqueness checks (A1-A3).

Every row whose non-null key occurs more than once is reported, one output row
per occurrence. Duplicate keys are found by a grouped count, which Spark
pre-aggregates map-side, so a hot key costs one partial row per task before
the shuffle. Rows are matched to the duplicate keys by a semi join without a
hint: Spark broadcasts the keys where their bytes allow it, and otherwise
splits the large partitions of a hot key over several tasks.

Both sides are keyed by values of fixed width. Numbers, dates and the like are
compared as they are; text, binary and nested values by the SHA-256 digest of
their typed JSON or bytes, so whole texts are never counted, shuffled or
broadcast as keys. Two different values with one SHA-256 are not to be met.

Nothing runs while the plan is built: no checkpoint, no size probe.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.projection import joined_text
from tessera.operators.fused import ACTUAL, PK_VALUE, column_types, resolve, scope_columns

OCCURRENCES = "_occurrences"
FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
               T.DateType, T.TimestampType, T.TimestampNTZType)


def fixed_width(column: Column, dtype: T.DataType) -> Column:
    """The value itself, or its digest where its width is not fixed.

    The digest of NULL is empty bytes, which is no value's digest: never NULL, it spares the
    null test that a join would add, and with it a second evaluation.
    """
    if isinstance(dtype, FIXED_WIDTH):
        return column
    data = column.cast("binary") if isinstance(dtype, (T.StringType, T.BinaryType)) else F.to_json(F.struct(column)).cast("binary")
    return F.when(column.isNull(), F.lit(b"")).otherwise(F.coalesce(F.unhex(F.sha2(data, 256)), F.lit(b"")))


def key_columns(df: DataFrame, key_cols: list[str]) -> dict[str, Column]:
    types = column_types(df)
    return {f"_key{i}": fixed_width(F.col(c), resolve(types, c)) for i, c in enumerate(key_cols)}


def _keyed(df: DataFrame, key_cols: list[str]) -> DataFrame:
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in key_cols])).withColumns(key_columns(df, key_cols))


def duplicate_keys(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Fixed-width keys occurring more than once, with their number of occurrences."""
    keyed = _keyed(df, key_cols)
    names = list(key_columns(df, key_cols))
    return (keyed.groupBy(*names).agg(F.count(F.lit(1)).alias(OCCURRENCES)).where(F.col(OCCURRENCES) > 1))


def duplicate_rows(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows of ``df`` whose (non-null) key occurs more than once."""
    names = list(key_columns(df, key_cols))
    return _keyed(df, key_cols).join(duplicate_keys(df, key_cols).select(*names), names, "left_semi").select(*df.columns)


def rows_without_duplicates(df: DataFrame, key_cols: list[str], among: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key holds a NULL or is not a duplicate among the rows of ``among``."""
    names = list(key_columns(df, key_cols))
    dups = duplicate_keys(among, key_cols).select(*names)
    return df.withColumns(key_columns(df, key_cols)).join(dups, names, "left_anti").select(*df.columns)


def duplicate_failures(df: DataFrame, key_cols: list[str], pk_cols: list[str], scope: str | None = None) -> DataFrame:
    """With ``scope`` a key is a duplicate within rows of one scope."""
    within = key_cols + ([scope] if scope else [])
    rows = duplicate_rows(df.select(*dict.fromkeys(pk_cols + within)), within)
    return rows.select(joined_text(pk_cols).alias(PK_VALUE), joined_text(key_cols).alias(ACTUAL), *scope_columns(scope))
