"""Uniqueness across windows (A1 over runs): a key seen in an earlier window is a duplicate in a later one.

The keys of judged windows are kept as 128-bit digests with the start of the window that first held them, in a table
bucketed by digest. A window's rows are joined with it bucket by bucket: the history is neither shuffled nor sorted
anew for its partitioning, and the earlier windows' rows are not read. After the window is judged its new keys
are appended.

A window's own keys never count against it: only keys of windows that start before it do, so a window that is judged
again gives the same rows, and remembering it again adds nothing. NULL key parts make no key, as in any
uniqueness check.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.projection import joined_text, sql_string, ts_lit
from tessera.operators.fused import ACTUAL, PK_VALUE
from tessera.operators.keys import duplicate_rows, key_columns

BUCKETS = 64
COLUMNS = "h1 BIGINT, h2 BIGINT, since TIMESTAMP"


class KeyHistory:
    """The key digests of one uniqueness rule, at a path on shared storage. All sessions must name the same number
    of buckets."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "key_history_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        # The session's catalog only names the files: a new session finds them as they are.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({COLUMNS}) USING parquet "
                  f"CLUSTERED BY (h1, h2) INTO {int(buckets)} BUCKETS LOCATION {sql_string(path)}")

    def keys(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def earlier(self, start: dt.datetime) -> DataFrame:
        return self.keys().where(F.col("since") < ts_lit(start)).select("h1", "h2")

    def remember(self, window: DataFrame, key_cols: list[str], start: dt.datetime) -> None:
        """Append the window's keys that the history does not hold yet."""
        own = _digested(window, key_cols).select("h1", "h2").distinct()
        new = own.join(self.keys().select("h1", "h2"), ["h1", "h2"], "left_anti").withColumn("since", ts_lit(start))
        new.repartition(self.buckets, "h1", "h2").write.mode("append").format("parquet").bucketBy(self.buckets, "h1", "h2").option(
            "path", self.path).saveAsTable(self.table)

    def forget_name(self) -> None:
        """Drop the name from the session's catalog; the files stay."""
        try:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        except AnalysisException:
            pass


def _digested(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows with a whole key, and its digest: of the fixed-width values that every uniqueness check compares."""
    parts = list(key_columns(df, key_cols).values())
    there = [F.col(c).isNotNull() for c in key_cols]
    out = df
    for condition in there:
        out = out.where(condition)
    return out.withColumns({"h1": F.xxhash64(F.lit("key"), *parts), "h2": F.xxhash64(F.lit("again"), *parts)})


def repeated_rows(window: DataFrame, key_cols: list[str], history: KeyHistory, start: dt.datetime) -> DataFrame:
    """Rows whose key an earlier window held."""
    return (_digested(window, key_cols).join(history.earlier(start), ["h1", "h2"], "left_semi").select(*window.columns))


def uniqueness_failures(window: DataFrame, key_cols: list[str], pk_cols: list[str], history: KeyHistory,
                        start: dt.datetime) -> DataFrame:
    """(key of the row, value, Repeats): rows whose key is repeated within the window (``window``), was held by an
    earlier one (``history``), or both (``window, history``)."""
    needed = window.select(*dict.fromkeys(pk_cols + key_cols))
    shown = [joined_text(pk_cols).alias(PK_VALUE), joined_text(key_cols).alias(ACTUAL)]
    inside = duplicate_rows(needed, key_cols).select(*shown, F.lit("window").alias("Repeats"))
    before = repeated_rows(needed, key_cols, history, start).select(*shown, F.lit("history").alias("Repeats"))
    return (inside.unionByName(before).groupBy(PK_VALUE, ACTUAL)
            .agg(F.array_join(F.array_sort(F.collect_set("Repeats"), lambda a, b: F.when(a > b, -1).otherwise(1)), ", ").alias("Repeats")))
