"""SQL-defined checks: custom SQL on the object (P13), registered Python checks
(P14) and business rules (B1, B2, B5, J5, J6, A13).

A business rule is a SELECT returning the failing rows. Its window tokens are
replaced by the run's bounds (plain token replacement, so braces in regexes stay
intact), a trailing ``;`` is dropped, and backticked ``project.dataset.table``
names are rewritten to the registered view ``dataset_table``. Spark SQL plans it
like any other query. Rule text is only ever a query: see ``query``.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from tessera.functions.projection import joined_text, ts_text
from tessera.operators.fused import ACTUAL, PK_VALUE, scope_columns
from tessera.operators.lookups import view_name

CUSTOM_SQL_VIEW = "dfSQL"
START_TOKEN, END_TOKEN = "{val_st_dt}", "{val_end_dt}"

# Registry of named Python checks: DataFrame -> failing rows (P14). Code is given
# here, never taken from catalog text.
PYTHON_CHECKS: dict[str, Callable[[DataFrame], DataFrame]] = {}


class SqlRuleError(ValueError):
    pass


def register_python_check(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    PYTHON_CHECKS[name] = fn


def _outside_quotes(sql: str) -> str:
    return re.sub(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"", "''", sql)


def render_business_sql(sql: str, start: dt.datetime | None, end: dt.datetime | None) -> str:
    text = sql.strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    if ";" in _outside_quotes(text):
        raise SqlRuleError("business rule must be a single SELECT statement")
    if START_TOKEN in text:
        if start is None:
            raise SqlRuleError("rule uses {val_st_dt} but the run has no window")
        text = text.replace(START_TOKEN, ts_text(start))
    if END_TOKEN in text:
        if end is None:
            raise SqlRuleError("rule uses {val_end_dt} but the run has no window")
        text = text.replace(END_TOKEN, ts_text(end))
    # only table references (after FROM / JOIN) are renamed; backticked columns stay as they are
    return re.sub(r"(?i)\b(from|join)(\s+)`([^`]+)`",
                  lambda m: f"{m.group(1)}{m.group(2)}{view_name(m.group(3))}" if "." in m.group(3) else m.group(0),
                  text)


def query(spark: SparkSession, sql: str) -> DataFrame:
    """The rows of one SELECT; text that is no query is refused before anything runs.

    Standing as a subquery, the text can only be a query: the parser knows no command,
    insert or second statement there. A query may still call out to a program; such plans
    are refused by what they hold.
    """
    try:
        found = spark.sql(f"SELECT * FROM (\n{sql}\n) AS rule_rows")
    except ParseException as exc:
        raise SqlRuleError(f"not a single query: {str(exc).strip().splitlines()[0][:300]}") from exc
    plan = found._jdf.queryExecution().analyzed().toString()
    if "ScriptTransformation" in plan or re.search(r"\b(java_method|reflect)\(", plan):
        raise SqlRuleError("a rule may not call programs or methods")
    return found


def project_failures(failing: DataFrame, pk_cols: list[str], value_cols: list[str], scope: str | None = None) -> DataFrame:
    """Failing rows of any SQL check -> (PK value, actual value) (P17/B2). With ``scope`` the query must
    give that column too (as ``SELECT *`` does), or its rows belong to no file."""
    missing = [c for c in pk_cols + value_cols + ([scope] if scope else []) if c.lower() not in {x.lower() for x in failing.columns}]
    if missing:
        raise SqlRuleError(f"query result lacks column(s) {missing}")
    return failing.select(joined_text(pk_cols).alias(PK_VALUE), joined_text(value_cols).alias(ACTUAL), *scope_columns(scope))


def custom_sql_failures(spark: SparkSession, df: DataFrame, sql: str) -> DataFrame:
    # The query is analysed at once, so the view is bound now; a later object
    # re-registering the same view name does not change this plan.
    df.createOrReplaceTempView(CUSTOM_SQL_VIEW)
    return query(spark, sql.strip().rstrip(";"))


def python_failures(df: DataFrame, name: str) -> DataFrame:
    fn = PYTHON_CHECKS.get(name.strip())
    if fn is None:
        raise SqlRuleError(f"no registered Python check named {name!r}")
    return fn(df)


def business_failures(spark: SparkSession, sql: str, start: dt.datetime | None,
                      end: dt.datetime | None) -> DataFrame:
    return query(spark, render_business_sql(sql, start, end))
