"""Failing conditions of the row-local tests (P1-P9, P11), as SQL expressions.

Each builder returns the text of a boolean expression that never throws under
ANSI mode; where a value is NULL it is NULL or false, so a filter on it drops
the row and can be pushed into the scan as it stands. ``total`` makes it never
NULL, for projections, counts and negation. NULL values are skipped by every
value test and only caught by the null test. Values that cannot be read as the bound's type (``'abc'`` against
``min 5``) are not failures of min/max/date tests; the type and regex tests
report them.

Conditions are built as text so that a rule costs one expression to hand to
Spark (``F.expr``) however many parts it has. Column names are backquoted and
every rule value enters as a typed literal (text through ``sql_string``, which
reads the same under every parser setting); no rule text is pasted as SQL.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import types as T

from tessera.functions.projection import quote_name, sql_string, ts_text

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)

_NUMBER_TEXT = re.compile(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$")
_INT32, _INT64 = 2 ** 31, 2 ** 63


class RuleValueError(ValueError):
    """The test value of a rule cannot be used (wrong shape or type)."""


def total(cond: str) -> str:
    return f"coalesce({cond}, false)"


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def as_number(value: Any) -> float | int | None:
    if _is_number(value):
        return value
    if isinstance(value, str) and _NUMBER_TEXT.match(value):
        text = value.strip()
        return int(text) if re.fullmatch(r"[-+]?\d+", text) else float(text)
    return None


def number_sql(value: int | float) -> str:
    """A numeric literal: INT or BIGINT for whole numbers in range, else DOUBLE."""
    if isinstance(value, int) and -_INT32 <= value < _INT32:
        return str(value)
    if isinstance(value, int) and -_INT64 <= value < _INT64:
        return f"{value}L"
    value = float(value)
    text = repr(value) if not (math.isnan(value) or math.isinf(value)) else str(value)
    return f"CAST('{text}' AS DOUBLE)"


def is_whole_literal(value: int | float) -> bool:
    """Whether ``number_sql`` writes an INT or BIGINT."""
    return isinstance(value, int) and -_INT64 <= value < _INT64


def _double_sql(value: int | float) -> str:
    return number_sql(float(value))


def is_null(col: str) -> str:
    return f"{quote_name(col)} IS NULL"


def regex_mismatch(col: str, pattern: str) -> str:
    q = quote_name(col)
    return f"{q} IS NOT NULL AND NOT (CAST({q} AS STRING) RLIKE {sql_string(pattern)})"


def value_operands(col: str, dtype: T.DataType, bound: Any) -> tuple[str, str]:
    q = quote_name(col)
    number = as_number(bound)
    if isinstance(dtype, NUMERIC):
        if number is None:
            raise RuleValueError(f"bound {bound!r} is not a number for {dtype.simpleString()} column {col}")
        return q, number_sql(number)
    if isinstance(dtype, T.StringType):
        if number is not None:
            return f"try_cast({q} AS DOUBLE)", _double_sql(number)
        return q, sql_string(str(bound))
    if isinstance(dtype, TEMPORAL):
        if number is not None:
            raise RuleValueError(f"numeric bound {bound!r} on {dtype.simpleString()} column {col}")
        return q, f"try_cast({sql_string(str(bound))} AS {dtype.simpleString()})"
    if number is not None:
        return f"try_cast(CAST({q} AS STRING) AS DOUBLE)", _double_sql(number)
    return f"CAST({q} AS STRING)", sql_string(str(bound))


def below_min(col: str, dtype: T.DataType, bound: Any) -> str:
    lhs, rhs = value_operands(col, dtype, bound)
    return f"{lhs} < {rhs}"


def above_max(col: str, dtype: T.DataType, bound: Any) -> str:
    lhs, rhs = value_operands(col, dtype, bound)
    return f"{lhs} > {rhs}"


def _length_bound(bound: Any) -> int:
    number = as_number(bound)
    if number is None or int(number) != number:
        raise RuleValueError(f"length bound must be an integer, got {bound!r}")
    return int(number)


def length_operands(col: str, bound: Any) -> tuple[str, str]:
    return f"length(CAST({quote_name(col)} AS STRING))", number_sql(_length_bound(bound))


def shorter_than(col: str, bound: Any) -> str:
    lhs, rhs = length_operands(col, bound)
    return f"{lhs} < {rhs}"


def longer_than(col: str, bound: Any) -> str:
    lhs, rhs = length_operands(col, bound)
    return f"{lhs} > {rhs}"


def resolve_date_bound(bound: Any, today: dt.date, now: dt.datetime) -> dt.date | dt.datetime:
    """Bound text -> date (day granularity) or datetime. ``CURRENT_DATE`` is the run's day."""
    if isinstance(bound, (dt.datetime, dt.date)):
        return bound
    if not isinstance(bound, str):
        raise RuleValueError(f"date bound must be text, got {bound!r}")
    text = bound.strip()
    token = text.upper().replace("()", "")
    if token == "CURRENT_DATE":
        return today
    if token in ("CURRENT_TIMESTAMP", "NOW"):
        return now
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        pass
    try:
        return dt.datetime.fromisoformat(text)
    except ValueError as exc:
        raise RuleValueError(f"cannot read date bound {bound!r}") from exc


def _value_as_timestamp(col: str, dtype: T.DataType, fmt: str | None) -> str:
    q = quote_name(col)
    if isinstance(dtype, TEMPORAL):
        return q
    if fmt is not None and not isinstance(fmt, str):
        raise RuleValueError(f"date format must be text, got {fmt!r}")
    text = f"CAST({q} AS STRING)"
    return f"try_to_timestamp({text}, {sql_string(fmt)})" if fmt else f"try_to_timestamp({text})"


def date_operands(col: str, dtype: T.DataType, bound: Any, today: dt.date,
                   now: dt.datetime) -> tuple[str, str]:
    fmt = None
    if isinstance(bound, (list, tuple)):
        if len(bound) != 2:
            raise RuleValueError(f"date bound list must be [value, format], got {bound!r}")
        bound, fmt = bound
    value = _value_as_timestamp(col, dtype, fmt)
    resolved = resolve_date_bound(bound, today, now)
    if isinstance(resolved, dt.datetime):
        target = "TIMESTAMP_NTZ" if isinstance(dtype, T.TimestampNTZType) else "TIMESTAMP"
        return value, f"CAST('{ts_text(resolved)}' AS {target})"
    return f"to_date({value})", f"DATE '{resolved.isoformat()}'"


def before_date(col: str, dtype: T.DataType, bound: Any, today: dt.date, now: dt.datetime) -> str:
    lhs, rhs = date_operands(col, dtype, bound, today, now)
    return f"{lhs} < {rhs}"


def after_date(col: str, dtype: T.DataType, bound: Any, today: dt.date, now: dt.datetime) -> str:
    lhs, rhs = date_operands(col, dtype, bound, today, now)
    return f"{lhs} > {rhs}"


def _text(value: Any) -> str:
    """A list value as Spark renders it as text (booleans lower case)."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _membership(col: str, dtype: T.DataType, values: Sequence[Any]) -> str | None:
    vals = [v for v in values if v is not None]
    if not vals:
        return None
    q = quote_name(col)
    if isinstance(dtype, T.StringType):
        return f"{q} IN ({', '.join(sql_string(_text(v)) for v in vals)})"
    if isinstance(dtype, T.BooleanType) and all(isinstance(v, bool) for v in vals):
        return f"{q} IN ({', '.join('true' if v else 'false' for v in vals)})"
    if isinstance(dtype, NUMERIC):
        numbers = [as_number(v) for v in vals]
        if all(n is not None for n in numbers):
            return f"{q} IN ({', '.join(number_sql(n) for n in numbers)})"
    return f"CAST({q} AS STRING) IN ({', '.join(sql_string(_text(v)) for v in vals)})"


def not_in_list(col: str, dtype: T.DataType, values: Sequence[Any]) -> str:
    member = _membership(col, dtype, values)
    q = quote_name(col)
    if member is None:
        return f"{q} IS NOT NULL"
    return f"{q} IS NOT NULL AND NOT ({member})"


def in_list(col: str, dtype: T.DataType, values: Sequence[Any]) -> str:
    member = _membership(col, dtype, values)
    if member is None:
        return "false"
    return f"{quote_name(col)} IS NOT NULL AND ({member})"
