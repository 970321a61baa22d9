"""RDBMS source (S4): JDBC read options with window pushdown and parallel reads.

The window becomes part of the pushed query, so the database returns only the
window's rows; ``partitionColumn`` / bounds / ``numPartitions`` split the read
across executors instead of one connection. A full-table read has no filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.projection import ts_text


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 date_col: str | None = None, start: dt.datetime | None = None,
                 end: dt.datetime | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10000,
                 driver: str | None = None) -> dict[str, str]:
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size)}
    conds = []
    if date_col and start is not None:
        conds.append(f"{date_col} >= '{ts_text(start)}'")
    if date_col and end is not None:
        conds.append(f"{date_col} < '{ts_text(end)}'")
    if conds:
        opts["dbtable"] = f"(SELECT * FROM {table} WHERE {' AND '.join(conds)}) src"
    else:
        opts["dbtable"] = table
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    return opts


def with_bounds(options: dict[str, str], key: str, bounds: tuple[int, int] | None, num_partitions: int) -> dict[str, str]:
    """The options split by a numeric key between its least and largest value; unsplit where there are none."""
    if not bounds or bounds[0] is None:
        return options
    low, high = int(bounds[0]), int(bounds[1]) + 1
    return {**options, "partitionColumn": key, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(max(1, min(num_partitions, high - low)))}


def _load(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def read_jdbc(spark: SparkSession, options: dict[str, str], key: str | None = None, load=_load) -> DataFrame:
    """Read a table; with a numeric ``key`` (the primary key, as a rule) over several connections.

    The key's bounds are asked of the database in one row, over the same window, before the read.
    """
    if key and "partitionColumn" not in options:
        asked = {**options, "dbtable": f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {options['dbtable']}) b"}
        row = load(spark, asked).first()
        options = with_bounds(options, key, row and (row[0], row[1]), spark.sparkContext.defaultParallelism)
    return load(spark, options)
