"""Line dedup: hashes of lines range-partitioned, sorted by document and position, first occurrences
streamed; the result is a run-length compressed keep bitmap per document. DataFrame functions throughout.

A line's key is the line without white space (the six ASCII characters) at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points that two documents hold lose all their lines but those in the
least document that holds them; other lines stay. Keys are compared by two 64-bit hashes of different seeds.

Lines become narrow rows (hash, document, position), read from the texts once. These are range-partitioned by
(hash, cell) and sorted by document and position within; one running window carries a hash's first document
along and marks the rows of later documents. A hash's rows are one cell, but for hot hashes: those with more
rows than a quarter of a partition. Hot hashes are counted exactly: rows per band of hashes (16 bands a
partition, pre-aggregated), then per hash in the bands that hold more rows than the limit - at most four hot
hashes a partition, whatever the data, so they are broadcast. A hot hash is dealt to as many cells as it holds
limits, by document, and its least document comes from the same count.

Marked positions are grouped by document into runs. A document's keep bitmap is the list of its runs of kept
lines ``(first, count)``, positions from 0; texts move only where kept texts are asked for.

NULL ids are one document that comes after all others; NULL or empty texts are one empty line. Rows that agree
in id and text are one document and get the same bitmap; rows that share an id alone are judged line by line and
never take lines from each other. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, kept, release, saved, shuffle_partitions

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_CHARS = 10
BANDS_PER_PARTITION = 16
LIMITS_PER_PARTITION = 4
LEAST_LIMIT = 1_000          # rows a hash may always have in one cell


def line_key(line: Column) -> Column:
    """Stripped and A-Z lower-cased; ``lower`` does that for lines of ASCII alone, and faster."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(ascii_lower(bare))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text_hash, text) of every row; text_hash tells rows of one id apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    lines = _texts(docs, id_col, text_col).select("doc", "text_hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return (lines.select("doc", "text_hash", "pos", line_key(F.col("line")).alias("key"))
            .filter(F.length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "text_hash", "pos"))


def hot_hashes(lines: DataFrame, limit: int, bands: int) -> DataFrame:
    """(h1, h2, cells, first) of all hashes with more than ``limit`` rows: fewer than rows / limit of them."""
    band = F.pmod("h1", F.lit(bands))
    full = lines.groupBy(band.alias("band")).count().filter(F.col("count") > limit).select("band")
    return (lines.join(F.broadcast(full), band == full["band"], "left_semi").groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("doc").alias("first")).filter(F.col("rows") > limit)
            .select("h1", "h2", F.ceil(F.col("rows") / limit).alias("cells"), "first"))


def later_lines(lines: DataFrame, least_limit: int = LEAST_LIMIT) -> DataFrame:
    """The (doc, text_hash, pos) rows of ``lines`` whose hash an earlier document holds."""
    parts = shuffle_partitions(lines.sparkSession)
    limit = max(least_limit, math.ceil(lines.count() / (parts * LIMITS_PER_PARTITION)))
    hot = hot_hashes(lines, limit, parts * BANDS_PER_PARTITION)
    cell = F.coalesce(1 + F.pmod(F.xxhash64("doc"), "cells"), F.lit(0))
    ranged = (lines.join(F.broadcast(hot), ["h1", "h2"], "left")
              .select("h1", "h2", cell.alias("cell"), "doc", "text_hash", "pos", F.col("cells").isNotNull().alias("is_hot"), "first")
              .repartitionByRange("h1", "h2", "cell"))
    stream = (Window.partitionBy("h1", "h2", "cell").orderBy(F.asc_nulls_last("doc"), "pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.when(F.col("is_hot"), F.col("first")).otherwise(F.first("doc").over(stream))
    return (ranged.withColumn("owner", first).filter(~F.col("owner").eqNullSafe(F.col("doc")))
            .select("doc", "text_hash", "pos"))


def _runs(places: Column) -> Column:
    """Sorted positions as runs (first, count). ``places`` must be a bound variable or a plain column."""
    firsts = F.filter(places, lambda x, i: ~F.get(places, i - 1).eqNullSafe(x - 1))
    lasts = F.filter(places, lambda x, i: ~F.get(places, i + 1).eqNullSafe(x + 1))
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("count")))


def dropped_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 least_limit: int = LEAST_LIMIT) -> DataFrame:
    """(doc, text_hash, gone): the dropped runs of the documents that lose lines, written to the shared folder."""
    lines = kept(line_hashes(docs, id_col, text_col, min_chars))
    places = later_lines(lines, least_limit).groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    # The array is bound to a variable, so that no element look-up evaluates it again.
    runs = saved(places.select("doc", "text_hash", F.transform(F.array("places"), _runs)[0].alias("gone")), "line-runs")
    release(lines)
    return runs


def _with_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows with (doc, text_hash, n_lines): number of dropped lines and the keep bitmap."""
    runs = runs.select(F.col("doc").alias("run_doc"), F.col("text_hash").alias("run_hash"), "gone")
    met = rows.join(runs, rows["doc"].eqNullSafe(runs["run_doc"]) & (rows["text_hash"] == runs["run_hash"]), "left")
    gone = F.coalesce("gone", F.array().cast("array<struct<first:int,count:int>>"))
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda r: r["first"] + r["count"]))
    ends = F.concat(F.transform(gone, lambda r: r["first"]), F.array("n_lines"))
    keep = F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), (b - a).alias("count"))), lambda r: r["count"] > 0)
    n_dropped = F.aggregate(gone, F.lit(0).cast("long"), lambda n, r: n + r["count"])
    return met.withColumns({"n_dropped": n_dropped, "keep": keep})


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 least_limit: int = LEAST_LIMIT) -> DataFrame:
    """Per row: id, text_hash, n_lines, n_dropped, keep (runs of kept lines). No text is shuffled."""
    runs = dropped_runs(docs, id_col, text_col, min_chars, least_limit)
    rows = _texts(docs, id_col, text_col).select("doc", "text_hash", F.size(F.split("text", "\n")).alias("n_lines"))
    return _with_runs(rows, runs).select(F.col("doc").alias(id_col), "text_hash", F.col("n_lines").cast("long").alias("n_lines"),
                                         "n_dropped", "keep")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                           least_limit: int = LEAST_LIMIT) -> DataFrame:
    """Per row: id, n_lines, n_dropped, keep, and the kept lines joined by a line end."""
    runs = dropped_runs(docs, id_col, text_col, min_chars, least_limit)
    # Equal to the number of parts a split gives, without splitting before the shuffle.
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    rows = _with_runs(_texts(docs, id_col, text_col).withColumn("n_lines", n_lines), runs)
    lines_kept = F.transform(F.array(F.split("text", "\n")), lambda lines: F.array_join(
        F.flatten(F.transform("keep", lambda r: F.slice(lines, r["first"] + 1, r["count"]))), "\n"))[0]
    return rows.select(F.col("doc").alias(id_col), F.col("n_lines").cast("long").alias("n_lines"), "n_dropped", "keep",
                       F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(lines_kept).alias("kept"))
