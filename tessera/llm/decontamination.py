"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words; words under a 0 are ignored, so a copy
with some words replaced still agrees on some seed. The seeds of the benchmark items are
hashed into sorted arrays, which every task holds while it streams whole documents; items
are taken in blocks of bounded seed count (one pass over the documents per block), so
what is broadcast has a fixed size bound whatever the benchmark.

Every hit is verified on its diagonal: document and item are laid over each other, and
the longest run with at least 0.8 agreement must cover ``MIN_OVERLAP`` words, or the whole
item if that is shorter. Wherever the replaced words stand, such a run leaves a seed: the
masks meet every choice of 1 word in 10, 2 in 13, 3 in 15 and 4 in 20, and a run of any
length from 13 words has a stretch of one of these with no more replaced. Items of 8 to 12
words have shorter masks, which meet every choice of a fifth of their words; items of 5 to
7 words are sought by all their words, and items under ``MIN_ITEM`` words are no passages
and never match.

Words are compared lower-cased and without punctuation at their edges; words of nothing
else are left out. NULL and empty texts or items match nothing, NULL ids stay NULL,
repeated rows get equal results, an empty benchmark leaves all documents clean, empty
tables give empty results, and extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Memo, bound_batches, hash64, kept, lean, text_slices

EDGE = ".,;:!?\"'()[]{}<>«»¿¡-–—_*`"
# The masks, 1 where a word counts.
MASKS = ("1110100110111", "1101011001011", "1111111",
         "111010111", "111010000111", "100100111011", "101100110101", "110101111")
SHORT_MASKS = ("111011", "11010011", "11111")  # of items under MIN_OVERLAP words
MIN_ITEM = 5
MIN_SPACED = 8            # items of fewer words are sought by all their words
MIN_OVERLAP = 13
RUN_SCORES = (1, -4)  # of an agreeing and a differing word: at least 0 in a run with 0.8 agreement
BLOCK_SEEDS = 500_000
FILTER_BITS = 22
MULTIPLIERS = hash64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def word_hash(word: bytes) -> int:
    clean = word.decode("utf-8", "replace").strip(EDGE).lower()
    return xxhash.xxh64_intdigest(clean) | 1 if clean else 0


def hashed_words(text: bytes, memo: Memo) -> np.ndarray:
    got = np.array([memo[w] for w in text.split()], np.uint64)
    return got[got != 0]


def seeds_of(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the mask laid at every position."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(len(mask)), np.uint64)
    for at, bit in enumerate(mask):
        if bit == "1":
            total += words[at:at + n] * MULTIPLIERS[at]
    return hash64(total)


def masks_for(length: int) -> tuple[str, ...]:
    return MASKS if length >= MIN_OVERLAP else SHORT_MASKS if length >= MIN_SPACED else ("1" * length,)


def block_of(items: list[tuple[int | None, np.ndarray]]) -> tuple[list, dict]:
    """Items, and per mask their seeds, sorted, with the item and position each stems from and a bit filter."""
    by_mask: dict[str, list] = {}
    for number, (_, words) in enumerate(items):
        for mask in masks_for(len(words)):
            seeds = seeds_of(words, mask)
            by_mask.setdefault(mask, []).append((seeds, np.full(len(seeds), number), np.arange(len(seeds))))
    tables = {}
    for mask, parts in by_mask.items():
        seeds, owner, place = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(seeds, kind="stable")
        maybe = np.zeros(1 << FILTER_BITS, bool)
        maybe[seeds >> np.uint64(64 - FILTER_BITS)] = True
        tables[mask] = (seeds[order], owner[order].astype(np.int32), place[order].astype(np.int32), maybe)
    return items, tables


def blocks_of(benchmark: DataFrame, seeds_most: int):
    """Benchmark items in blocks of bounded seeds; the driver holds one block at a time."""
    memo, items, seeds = Memo(word_hash), [], 0
    for row in benchmark.toLocalIterator():
        words = hashed_words((row["text"] or "").encode(), memo)
        if len(words) < MIN_ITEM:
            continue
        # One very long item is cut into overlapping pieces, so a block's bound holds for it too.
        step = max(MIN_OVERLAP, seeds_most // len(MASKS) - MIN_OVERLAP)
        for at in range(0, max(1, len(words) - MIN_OVERLAP + 1), step):
            piece = words[at:at + step + MIN_OVERLAP - 1]
            items.append((row["id"], piece))
            seeds += len(piece) * len(MASKS)
            if seeds >= seeds_most:
                yield block_of(items)
                items, seeds = [], 0
    if items:
        yield block_of(items)


def longest_run(agree: np.ndarray) -> tuple[int, int, int]:
    """(start, length, agreeing words) of the longest run with agreement at least 0.8, of equal ones the most agreeing."""
    total = np.concatenate([[0], np.cumsum(np.where(agree, *RUN_SCORES))])
    # A run from i to j qualifies where total[j] >= total[i]; most[j] is the best total from j on and falls.
    most = np.maximum.accumulate(total[::-1])[::-1]
    length = np.searchsorted(-most, -total, "right") - 1 - np.arange(len(total))
    starts = np.flatnonzero(length == length.max())
    start = int(starts[np.argmax(total[starts + length[starts]] - total[starts])])
    end = start + int(length[start])
    return start, end - start, int(agree[start:end].sum())


def hits_in(flat: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray, block: tuple[list, dict]):
    """Verified (document number, item number, start, length, agreeing) of concatenated documents."""
    items, tables = block
    seen = set()
    for mask, (seeds, item_of, place_of, maybe) in tables.items():
        got = seeds_of(flat, mask)
        at = np.flatnonzero(maybe[got >> np.uint64(64 - FILTER_BITS)])
        low = np.searchsorted(seeds, got[at])
        high = np.searchsorted(seeds, got[at], "right")
        inside = (high > low) & (owner[at] == owner[np.minimum(at + len(mask) - 1, len(owner) - 1)])
        at, low, times = at[inside], low[inside], (high - low)[inside]
        entry = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        where = np.repeat(at, times)
        document = owner[where]
        diagonal = where - begin[document] - place_of[entry]
        seen.update(zip(document.tolist(), item_of[entry].tolist(), diagonal.tolist()))
    best: dict[tuple[int, int], tuple] = {}
    for document, number, diagonal in sorted(seen):
        words = items[number][1]
        doc = flat[begin[document]:end[document]]
        a, b = max(0, diagonal), min(len(doc), diagonal + len(words))
        start, length, agreeing = longest_run(doc[a:b] == words[a - diagonal:b - diagonal])
        if length >= min(MIN_OVERLAP, len(words)):
            key = (document, number)
            if key not in best or agreeing > best[key][2]:
                best[key] = (a + start, length, agreeing)
    return [(d, n, *x) for (d, n), x in best.items()]


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(id, text_hash, item_id, start, words, agreeing): verified overlaps of documents and items."""
    bound_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("id", F.xxhash64("text").alias("text_hash"), "text")
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    spark, kind = documents.sparkSession, docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash long, item_id long, start long, words long, agreeing long"
    found = None
    for block in blocks_of(items, block_seeds):
        shared = spark.sparkContext.broadcast(block)
        part = kept(docs.mapInArrow(lean(seek(shared)), schema))
        part.count()  # the block's pass; its broadcast is dropped from the executors before the next one's
        found = part if found is None else found.unionByName(part)
        shared.unpersist()
    return found if found is not None else spark.createDataFrame([], schema)


def seek(shared):
    def run(batches):
        block, memo = shared.value, Memo(word_hash)
        for batch in batches:
            rows, out = [], []
            for first, texts in text_slices(batch):
                docs = [hashed_words(t, memo) for t in texts]
                memo.trim()
                sizes = np.array([len(d) for d in docs])
                end = np.cumsum(sizes)
                flat = np.concatenate(docs)
                if not len(flat):
                    continue
                for document, number, *rest in hits_in(flat, np.repeat(np.arange(len(docs)), sizes), end - sizes, end, block):
                    rows.append(first + document)
                    out.append((block[0][number][0], *rest))
            columns = [list(x) for x in zip(*out)] if out else [[], [], [], []]
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", "text_hash", "item_id", "start", "words", "agreeing"])
    return run


def contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """Per document: id, contaminated, item_ids (ascending, distinct), overlap_words (of the longest overlap)."""
    hits = benchmark_hits(documents, benchmark, id_col, text_col, **options)
    per_doc = hits.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"),
                                                  F.max("agreeing").alias("overlap_words"))
    docs = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    met = docs.alias("d").join(per_doc.alias("h"), F.col("d.id").eqNullSafe(F.col("h.id")) &
                               (F.col("d.text_hash") == F.col("h.text_hash")), "left")
    return met.select(F.col("d.id").alias(id_col), F.col("overlap_words").isNotNull().alias("contaminated"),
                      F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
                      F.coalesce("overlap_words", F.lit(0)).cast("long").alias("overlap_words"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """The documents, all columns, without the contaminated ones."""
    hits = benchmark_hits(documents, benchmark, id_col, text_col, **options).select(
        F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    same = documents[id_col].eqNullSafe(hits["hit_id"]) & (F.xxhash64(documents[text_col].cast("string")) == hits["hit_hash"])
    return documents.join(hits, same, "left_anti")
