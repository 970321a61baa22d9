"""The commit log of result tables.

An attempt at an object run writes its rows of every result table under an ``Attempt`` partition of its
own. Only when all tables are written does one row per object run go to ``commits`` - the manifest - in
one small file. Readers follow it: of each object run they see the rows of the last committed attempt and
of no other. So a rerun that finds nothing replaces what an earlier attempt found, and an attempt that died
half-way is never seen, whatever it left.

After its commit an attempt removes the folders of committed attempts that it replaced with rows of its own.
Folders of attempts that left no successor in a table, and of attempts that died, stay until
``vacuum``, unseen by readers.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.clock import RunClock
from tessera.functions.local import local_frame
from tessera.functions.projection import date_lit, ts_lit
from tessera.sources.sinks import write_results

ATTEMPT = "Attempt"
OBJECT_RUN = ("Period", "Object_ID", "Run_ID")
PARTITIONS = (*OBJECT_RUN, ATTEMPT)
COMMITS = "commits"


def new_attempt(clock: RunClock) -> str:
    return f"{clock.now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def _read(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A table with rows, or None where nothing was written yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException:
        return None


def _commits(spark: SparkSession, out_dir: str) -> DataFrame | None:
    return _read(spark, f"{out_dir}/{COMMITS}", schemas.COMMITS)


def committed(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """(Period, Object_ID, Run_ID, Attempt): the last committed attempt of each object run."""
    rows = _commits(spark, out_dir)
    if rows is None:
        return None
    last = F.max_by(ATTEMPT, F.struct("Seq", ATTEMPT)).alias(ATTEMPT)
    return rows.groupBy(*OBJECT_RUN).agg(last)


def commit(spark: SparkSession, out_dir: str, runs: list[tuple[int, int, str]], clock: RunClock) -> None:
    """Make the attempts ``(Object_ID, Run_ID, Attempt)`` of the clock's day what readers see."""
    earlier = _commits(spark, out_dir)
    new = local_frame(spark, runs, "Object_ID int, Run_ID int, Attempt string").withColumn("Period", date_lit(clock.period))
    if earlier is None:
        rows = new.withColumn("Seq", F.lit(1))
    else:
        # One row per committed attempt: catalog-sized.
        last = earlier.where(F.col("Period") == date_lit(clock.period)).groupBy("Object_ID", "Run_ID").agg(F.max("Seq").alias("_last"))
        rows = new.join(F.broadcast(last), ["Object_ID", "Run_ID"], "left").withColumn("Seq", F.coalesce(F.col("_last") + 1, F.lit(1)))
    rows = rows.withColumn("Committed_At", ts_lit(clock.now)).select(*[F.col(f.name).cast(f.dataType) for f in schemas.COMMITS.fields])
    rows.coalesce(1).write.mode("append").parquet(f"{out_dir}/{COMMITS}")  # one file: all of it or nothing


def with_attempt(frame: DataFrame, runs: list[tuple[int, int, str]]) -> DataFrame:
    """Rows of several object runs, each with its attempt."""
    attempts = local_frame(frame.sparkSession, runs, "Object_ID int, Run_ID int, Attempt string")
    return frame.join(F.broadcast(attempts), ["Object_ID", "Run_ID"])


def write_attempt(frame: DataFrame, path: str, runs: list[tuple[int, int, str]]) -> None:
    write_results(with_attempt(frame, runs), path, partition_by=PARTITIONS)


def read_committed(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """The rows of a result table that readers are to see, without the attempt column."""
    known = schemas.RESULTS.get(table)
    rows = _read(spark, f"{out_dir}/{table}")  # no schema given: partition columns are found by the files
    live = committed(spark, out_dir)
    if rows is None or ATTEMPT not in rows.columns or live is None:
        if rows is not None and live is None and ATTEMPT not in rows.columns:
            return rows  # written without a commit log
        if known is None:
            raise AnalysisException(f"no result table {table!r} in {out_dir}")
        return local_frame(spark, [], known)
    # A row per object run: broadcast, so only the folders of committed attempts are read.
    seen = rows.join(F.broadcast(live), list(PARTITIONS), "left_semi").drop(ATTEMPT)
    return seen.select(*known.fieldNames()) if known is not None else seen


# ---- folders nobody reads any more ----------------------------------------------------

def _folders(spark: SparkSession, pattern: str) -> list:
    """File states of the folders that match a pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return list(found) if found is not None else []


def _delete(spark: SparkSession, path) -> None:
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_replaced(spark: SparkSession, out_dir: str, runs: list[tuple[int, int, str]], clock: RunClock) -> None:
    """Folders of committed attempts whose successor, just committed, wrote the same table."""
    day = clock.period.isoformat()
    mine = {(o, r): a for o, r, a in runs}
    old = {(r.Object_ID, r.Run_ID, r.Attempt) for r in _commits(spark, out_dir).where(F.col("Period") == date_lit(clock.period)).collect()}
    old = {x for x in old if mine.get(x[:2], x[2]) != x[2]}
    for table in schemas.RESULTS:
        for object_id, run_id, attempt in sorted(old):
            base = f"{out_dir}/{table}/Period={day}/Object_ID={object_id}/Run_ID={run_id}"
            if _folders(spark, f"{base}/{ATTEMPT}={mine[object_id, run_id]}"):
                for folder in _folders(spark, f"{base}/{ATTEMPT}={attempt}"):
                    _delete(spark, folder.getPath())


def vacuum(spark: SparkSession, out_dir: str, older_than: dt.datetime) -> list[str]:
    """Delete the folders of attempts that no reader sees - replaced or never committed - last changed
    before ``older_than`` (UTC); returns their paths. Run it when no attempt as old is still under way."""
    live_rows = committed(spark, out_dir)
    live = {tuple(map(str, r)) for r in live_rows.select(*PARTITIONS).collect()} if live_rows is not None else set()
    limit = older_than.replace(tzinfo=dt.timezone.utc).timestamp() * 1000
    gone = []
    for table in schemas.RESULTS:
        for folder in _folders(spark, f"{out_dir}/{table}/Period=*/Object_ID=*/Run_ID=*/{ATTEMPT}=*"):
            path = folder.getPath()
            values = tuple(part.partition("=")[2] for part in path.toString().rstrip("/").split("/")[-4:])
            if values not in live and folder.getModificationTime() < limit:
                _delete(spark, path)
                gone.append(path.toString())
    return gone

