"""Result sinks.

Results are written as ordinary Spark writes, partitioned so a day's (and an
object run's) results are pruned by partition. There is no staging file,
separate load step or emptiness probe: an empty frame simply writes no rows.

With ``replace_partitions`` the write replaces exactly the partitions it
produces (dynamic partition overwrite) and leaves all others alone, so
repeating the write of one object run after a failure does not duplicate it.

With ``counting`` the write also counts its rows, by an item of at most ``MAX_COUNTED`` values, as observed
metrics of the write itself: nothing is read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Most items that ``approx_top_k`` tracks. It is exact up to the number of items it is told to track.
MAX_COUNTED = 1_000_000


class Counting:
    """Counts rows by ``item`` where they are written. Counted behind the last shuffle, in the stage that writes: a task
    that is run again counts once."""

    def __init__(self, item: Column, items: int):
        self.item, self.items = item, max(1, items)
        self.observation = Observation(f"written-{uuid.uuid4().hex}")

    def of(self, df: DataFrame) -> DataFrame:
        top = F.call_function("approx_top_k", self.item, F.lit(self.items), F.lit(self.items))
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"), top.alias("counts"))

    def counts(self) -> dict:
        """Rows per item, once the write is through."""
        found = self.observation.get
        counts = {r["item"]: r["count"] for r in found["counts"]}
        if sum(counts.values()) != found["rows"]:
            raise ValueError(f"more than {self.items} items were written")
        return counts


def write_results(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple = ("Period",),
                  mode: str = "append", replace_partitions: bool = False, counting: Counting | None = None) -> None:
    # Rare failures over a large scan would leave a tiny file per task: AQE merges them before the write.
    df = df.hint("rebalance")
    if counting is not None:
        df = counting.of(df)
    writer = df.write.mode(mode).format(fmt)
    if replace_partitions:
        writer = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    cols = [c for c in partition_by if c in df.columns]
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)


def write_table(df: DataFrame, table: str, partition_by: tuple = ("Period",), mode: str = "append") -> None:
    writer = df.write.mode(mode)
    cols = [c for c in partition_by if c in df.columns]
    if cols:
        writer = writer.partitionBy(*cols)
    writer.saveAsTable(table)
