"""Row-local checks of one object, fused into a single pass.

All row-local failing conditions of an object become one projection over one
scan, however many there are: rows failing any check are kept (a plain OR of the
conditions, which reaches the scan where the source can evaluate it), each
failing (row, check) pair is emitted by exploding an array of
``when(cond_i, struct(check_i ids, value_i))``. Counts for every check and the
row count of the window come from one aggregate with a ``count_if`` per check.

Four or more bounds on one column are a ladder (see ``ladder``): one comparison and a
binary search for all of them, in the filter, the failing rows and the counts.

Hundreds of conditions in one generated method would exceed the JVM's JIT size
limit and run interpreted; the session's ``spark.sql.codegen.hugeMethodLimit``
(see ``session``) makes Spark fall back to its split projections there.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import predicates as P
from tessera.functions.projection import joined_text, joined_text_sql, sql_string
from tessera.operators.ladder import Ladder, Rung, rung_of, split
from tessera.operators.spec import Check

PK_VALUE = "Primary_Key_Value_s_"
SCOPE = "Source_File"  # which closed set of rows (an arriving file) a result belongs to, where there are several
ACTUAL = "Actual_Value"


class MissingColumnError(ValueError):
    pass


@dataclass(frozen=True)
class CompiledCheck:
    check: Check
    raw: str  # the failing condition; NULL where no part of it can tell
    rung: Rung | None = None  # where the check is a bound that can join a ladder

    @property
    def sql(self) -> str:
        """The failing condition, never NULL."""
        return P.total(self.raw)

    @property
    def condition(self) -> Column:
        return F.expr(self.sql)


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in df.schema.fields}


def resolve(types: dict[str, T.DataType], name: str) -> T.DataType:
    dtype = types.get(name.lower())
    if dtype is None:
        raise MissingColumnError(f"column {name!r} not found")
    return dtype


def _single(key: str, col: str, dtype: T.DataType, value, today: dt.date, now: dt.datetime) -> str:
    if key == "is_nullable":
        return P.is_null(col)
    if key == "regex":
        if not isinstance(value, str):
            raise P.RuleValueError(f"regex must be text, got {value!r}")
        return P.regex_mismatch(col, value)
    if key == "min":
        return P.below_min(col, dtype, value)
    if key == "max":
        return P.above_max(col, dtype, value)
    if key == "min_length":
        return P.shorter_than(col, value)
    if key == "max_length":
        return P.longer_than(col, value)
    if key == "min_date":
        return P.before_date(col, dtype, value, today, now)
    if key == "max_date":
        return P.after_date(col, dtype, value, today, now)
    if key in ("allowed", "forbidden"):
        if not isinstance(value, (list, tuple)):
            value = [value]
        return P.not_in_list(col, dtype, value) if key == "allowed" else P.in_list(col, dtype, value)
    raise P.RuleValueError(f"{key} is not a row-local test")


def compile_check(check: Check, types: dict[str, T.DataType], today: dt.date,
                  now: dt.datetime) -> CompiledCheck:
    """A row fails a multi-column check when any of its columns fails it.

    The condition is handed to Spark as one expression per check.
    """
    dtypes = [resolve(types, c) for c in check.columns]
    conds = [_single(check.key, c, t, check.value, today, now) for c, t in zip(check.columns, dtypes)]
    rung = rung_of(check.key, check.columns, dtypes[0], check.value, today, now) if dtypes else None
    return CompiledCheck(check, " OR ".join(f"({c})" for c in conds), rung)


def any_of_sql(conds: list[str]) -> str:
    """OR of many conditions as a balanced tree (shallow for analysis and codegen)."""
    conds = [f"({c})" for c in conds]
    while len(conds) > 1:
        conds = [f"({conds[i]} OR {conds[i + 1]})" if i + 1 < len(conds) else conds[i]
                 for i in range(0, len(conds), 2)]
    return conds[0]


def _needed(compiled: list[CompiledCheck]) -> list[Ladder | CompiledCheck]:
    """What tells whether a row fails any check: of a ladder, its first bound."""
    ladders, single = split(compiled)
    return [*ladders, *single]


def any_failing(compiled: list[CompiledCheck]) -> Column:
    """Never NULL, so it can be negated."""
    return F.expr(any_of_sql([P.total(part.raw) for part in _needed(compiled)]))


def some_failing(compiled: list[CompiledCheck]) -> Column:
    """For filters only: NULL where no check fails, and free of wrappers that would keep it from the scan."""
    return F.expr(any_of_sql([part.raw for part in _needed(compiled)]))


def _ids_sql(cc: CompiledCheck) -> str:
    m = cc.check.mapping
    return (f"'Mapping_ID', CAST({int(m.mapping_id)} AS INT), 'Rule_ID', CAST({int(m.rule_id)} AS INT), "
            f"'Object_ID', CAST({int(m.object_id)} AS INT), 'Column_Name', {sql_string(m.column_name or '')}")


def _check_struct_sql(cc: CompiledCheck) -> str:
    """The ids of a check and its failing value."""
    return f"named_struct({_ids_sql(cc)}, '{ACTUAL}', {joined_text_sql(list(cc.check.columns))})"


def _ladder_struct_sql(part: Ladder | CompiledCheck) -> str:
    """The ids of all checks a row fails of a ladder (or the one check), and the failing value."""
    checks = part.checks if isinstance(part, Ladder) else [part]
    ids = f"array({', '.join(f'named_struct({_ids_sql(cc)})' for cc in checks)})"
    failed = f"slice({ids}, 1, {part.rank})" if isinstance(part, Ladder) else ids
    return f"named_struct('ids', {failed}, '{ACTUAL}', {joined_text_sql(list(checks[0].check.columns))})"


def scope_columns(scope: str | None) -> list[Column]:
    return [F.col(scope).alias(SCOPE)] if scope else []


def fused_failures(df: DataFrame, compiled: list[CompiledCheck], pk_cols: list[str], scope: str | None = None) -> DataFrame:
    """(PK value, Mapping_ID, Rule_ID, Object_ID, Column_Name, Actual_Value) per failing row and check.

    Built from a few expressions whatever the number of checks.
    """
    ladders, single = split(compiled)
    if ladders:
        parts = ", ".join(f"CASE WHEN {part.raw} THEN {_ladder_struct_sql(part)} END" for part in [*ladders, *single])
        of = [SCOPE] if scope else []
        return (df.where(some_failing(compiled))
                .select(joined_text(pk_cols).alias(PK_VALUE), *scope_columns(scope), F.expr(f"explode(array({parts}))").alias("_f"))
                .where(F.col("_f").isNotNull())
                .select(PK_VALUE, *of, F.expr("inline(_f.ids)"), F.col(f"_f.{ACTUAL}").alias(ACTUAL)))
    items = ", ".join(f"CASE WHEN {cc.raw} THEN {_check_struct_sql(cc)} END" for cc in compiled)
    return (df.where(some_failing(compiled))
            .select(joined_text(pk_cols).alias(PK_VALUE), *scope_columns(scope), F.expr(f"explode(array({items}))").alias("_f"))
            .where(F.col("_f").isNotNull())
            .select(PK_VALUE, *([SCOPE] if scope else []), "_f.*"))


def _counts_pass(df: DataFrame, compiled: list[CompiledCheck], extra_ids: list[int], scope: str | None) -> DataFrame:
    row = df.groupBy(*scope_columns(scope)).agg(F.count(F.lit(1)).alias("_n"), *[
        F.expr(f"count_if({cc.raw})").alias(f"_c{i}") for i, cc in enumerate(compiled)])
    of = [SCOPE] if scope else []
    entries = [f"named_struct('Mapping_ID', CAST({int(cc.check.mapping.mapping_id)} AS INT), "
               f"'Failure_Count', CAST(_c{i} AS BIGINT))" for i, cc in enumerate(compiled)]
    entries += [f"named_struct('Mapping_ID', CAST({int(mid)} AS INT), 'Failure_Count', CAST(0 AS BIGINT))"
                for mid in extra_ids]
    if not entries:
        return row.selectExpr(*of, "CAST(NULL AS INT) AS Mapping_ID", "CAST(0 AS BIGINT) AS Failure_Count",
                              "CAST(_n AS BIGINT) AS Row_Count").where(F.lit(False))
    return (row.select(*of, F.col("_n").cast("long").alias("Row_Count"),
                       F.expr(f"explode(array({', '.join(entries)}))").alias("_e"))
            .select(*of, "_e.Mapping_ID", "_e.Failure_Count", "Row_Count"))


def _ladder_counts_pass(df: DataFrame, ladders: list[Ladder], single: list[CompiledCheck], extra_ids: list[int],
                        scope: str | None) -> DataFrame:
    """One aggregate again: rows by (part, number of its checks failed), part 0 for every row; each check's
    failures are then added up from the few rows of that histogram."""
    parts = [*ladders, *single]
    marks = ["named_struct('part', 0, 'rank', 1)"] + [
        f"CASE WHEN {part.raw} THEN named_struct('part', {i}, 'rank', {part.rank if isinstance(part, Ladder) else 1}) END"
        for i, part in enumerate(parts, 1)]
    of = [SCOPE] if scope else []
    rows = (df.select(*scope_columns(scope), F.expr(f"explode(array({', '.join(marks)}))").alias("_m"))
            .where(F.col("_m").isNotNull()).groupBy(*of, "_m.part", "_m.rank").agg(F.count(F.lit(1)).alias("n")))
    histogram = rows.groupBy(*of).agg(F.collect_list(F.struct("part", "rank", "n")).alias("_h"))
    places = [(cc, i, at) for i, part in enumerate(parts, 1)
              for at, cc in enumerate(part.checks if isinstance(part, Ladder) else [part], 1)]
    entries = [f"named_struct('Mapping_ID', CAST({int(cc.check.mapping.mapping_id)} AS INT), '_part', {i}, '_at', {at})"
               for cc, i, at in places]
    entries += [f"named_struct('Mapping_ID', CAST({int(mid)} AS INT), '_part', -1, '_at', 0)" for mid in extra_ids]
    added = "aggregate(_h, 0L, (_sum, x) -> IF(x.part = {} AND x.rank >= {}, _sum + x.n, _sum))"
    return (histogram.select(*of, "_h", F.expr(added.format(0, 0)).alias("Row_Count"), F.expr(f"inline(array({', '.join(entries)}))"))
            .select(*of, "Mapping_ID", F.expr(added.format("_part", "_at")).alias("Failure_Count"), "Row_Count"))


def fused_counts(df: DataFrame, compiled: list[CompiledCheck], mapping_ids: list[int], scope: str | None = None) -> DataFrame:
    """One aggregate over the source -> (Mapping_ID, Failure_Count, Row_Count) for every mapping.
    Mappings without row-local checks get a 0 count and still carry the row count.
    """
    covered = {cc.check.mapping.mapping_id for cc in compiled}
    extra = [mid for mid in mapping_ids if mid not in covered]
    ladders, single = split(compiled)
    if ladders:
        return _ladder_counts_pass(df, ladders, single, extra, scope)
    return _counts_pass(df, compiled, extra, scope)
