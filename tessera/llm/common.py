"""Helpers the operators share: words, row hashes, shared tables, bounded memos."""

from __future__ import annotations

import ctypes
import inspect
import math
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# Words are runs of anything but the six ASCII white-space characters. ``bytes.split()``
# splits on exactly those, so both sides agree on every text.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Texts are taken from Arrow batches in slices of about this many bytes, so one
# batch of long documents never multiplies in a worker's memory.
SLICE_BYTES = 2 << 20


def whole_rows(df: DataFrame) -> Column:
    """All columns as one struct: columns made beside it cannot clash with theirs, whatever their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def ascii_lower(column: Column | str) -> Column:
    """A-Z to a-z and nothing else (``lower`` would fold other alphabets too)."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; NULL ids fall into no held-out fold (-1)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(-1))


# Arrow batches of this many rows and bytes at most go to a Python worker.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def bound_batches(spark: SparkSession) -> None:
    """Documents vary from a word to megabytes: keep the batches that tasks hold small."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)


def give_back() -> None:
    """Return freed memory to the system: workers are reused by the stages that follow."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: nothing to return by hand


def lean(function: Callable) -> Callable:
    """An Arrow function over batches that gives memory back once its task's rows are through."""
    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()
    return run


def lean_group(function: Callable) -> Callable:
    """The same for functions over groups; Spark tells them apart by their number of arguments."""
    def call(*args):
        try:
            return function(*args)
        finally:
            give_back()
    by_count = {1: lambda a: call(a), 2: lambda a, b: call(a, b), 3: lambda a, b, c: call(a, b, c)}
    return by_count[len(inspect.signature(function).parameters)]


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-llm/{label}-{uuid.uuid4().hex}"


_MADE: list[list[DataFrame]] = []


@contextmanager
def releasing():
    """Frames that ``saved`` and ``kept`` make inside are dropped at the end, but those taken from the list given."""
    made: list[DataFrame] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE.pop()
        for frame in made:
            release(frame)


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    if _MADE:
        _MADE[-1].append(out)
    return out


def release(df: DataFrame) -> None:
    """Drop a frame made by ``saved`` or ``kept`` once nothing reads it any more."""
    path = getattr(df, "saved_path", None)
    if path:
        delete_path(df.sparkSession, path)
    else:
        df.unpersist()


def kept(df: DataFrame) -> DataFrame:
    """A frame that several jobs read: held on the executors' disks, with its lineage. What goes
    with a lost executor is computed anew from there."""
    out = df.persist(StorageLevel.DISK_ONLY)
    if _MADE:
        _MADE[-1].append(out)
    return out


def delete_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def input_bytes(df: DataFrame) -> int:
    """Size of what a frame reads, as the planner knows it; 0 where it does not."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Memo(dict):
    """word -> value, computed once; ``trim`` empties it beyond a fixed size, between documents."""

    def __init__(self, compute: Callable, limit: int = 100_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self[key] = self.compute(key)
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


def text_slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterable[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8 bytes) in slices of bounded bytes; NULL becomes empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    wide = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, min(rows, math.ceil(rows * size / max(1, wide.nbytes))))
    for start in range(0, rows, step):
        yield start, [t or b"" for t in wide.slice(start, step).to_pylist()]


def hash64(values: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit values (finaliser with two odd multipliers)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every run of ``length`` consecutive word hashes, by doubling."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, level, size = None, 0, words.astype(np.uint64, copy=False), 1
    rest = length
    while rest:
        if rest & 1:
            part = level[done:done + n]
            out = hash64(part) if out is None else hash64(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += size
        rest >>= 1
        if rest:
            level = hash64(level[:-size] * np.uint64(0xD6E8FEB86659FD93) + level[size:])
            size *= 2
    return out
