"""Removal of repeated passages with sharded FM-indexes.

A window is ``window`` consecutive words of one document; a word goes if a window that
covers it also starts in a document with a smaller id. Equal windows must meet without
every document meeting every shard, so windows are routed by content:

0. A document whose whole text also belongs to a smaller id is settled by that: digests of
   whole texts, least id per digest, pre-aggregated in every task.
1. Of the word 8-grams in a window the one with the least hash is its minimizer; equal
   windows choose the same. Consecutive windows with one minimizer form a run. Only
   (minimizer, document) rows are shuffled, and minimizers seen in a single document go.
2. The runs left, with the text around them, are dealt to shards by minimizer; a shard
   holds a bounded number of words. It builds a compressed FM-index of its distinct runs
   (suffix order, BWT in a wavelet matrix with rank blocks) and streams the runs backwards
   through it, all in step. The matching statistics, cut off at the window's length, give
   for every window the suffix interval of its occurrences, and the least document id in
   the interval decides.
3. The runs of a minimizer that has more than ``hot`` of them (copies, or a passage that very
   many documents share) are first grouped by content, pre-aggregated in every task: a run
   whose whole content starts in a smaller document is settled by that, and one run per
   content goes on to the shards. Should even the contents be more than ``contents`` (they
   differ in what surrounds the passage), their windows are settled one by one: a 128-bit
   digest per window, least id per digest, joined back to the windows.

Decisions are taken on the input alone. NULL texts have no words; rows without an id
neither lose words nor make others lose any; repeated rows with one id are alike, and
equal ids never remove each other's words. Empty tables give empty results; extra columns
are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Memo, bound_batches, hash64, kept, lean, lean_group, text_slices, window_hashes

PLACE_BITS = 28
ALL_WINDOWS = 1 << 30   # more than any text has
SEND_BYTES = 4 << 20    # of words in a batch that goes back to Spark, about


@dataclass
class Config:
    window: int = 50
    gram: int = 8
    hot: int = 4_096              # runs of a minimizer beyond which they are grouped by content first
    contents: int = 20_000        # contents of a minimizer beyond which its windows are settled by digest
    shard_words: int = 1_000_000  # words of a shard, about


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by doubling."""
    level, size = values, 1
    while size * 2 <= width:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    rest = width - size
    return np.minimum(level[:len(level) - rest], level[rest:]) if rest else level


def minimizer_runs(flat: np.ndarray, owner: np.ndarray, config: Config):
    """(first window, number of windows, minimizer) of every run in concatenated documents."""
    n = len(flat) - config.window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    grams = window_hashes(flat, config.gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hash64(grams) & ~low) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_minimum(ranked, config.window - config.gram + 1) & low).astype(np.int64)
    whole = owner[:n] == owner[config.window - 1:]
    new = np.ones(n, bool)
    # Windows whose minimizers are equal words at other places go on in one run: so a few words
    # repeated over and over are one run too.
    key = grams[place]
    new[1:] = (key[1:] != key[:-1]) | (owner[1:n] != owner[:n - 1]) | ~whole[:-1]
    start = np.flatnonzero(new & whole)
    stop = np.append(np.flatnonzero(new | ~whole), n)
    return start, stop[np.searchsorted(stop, start, "right")] - start, key[start]


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def run_rows(config: Config):
    """Arrow function: texts to runs. Of equal texts a task sends the runs of the least id it has met."""
    def run(batches):
        memo, met = Memo(word_hash), {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in text_slices(batch):
                parts = []
                for i, text in enumerate(texts, first):
                    digest = xxhash.xxh3_128_digest(text)
                    new = ids[i] < met.get(digest, ids[i] + 1)
                    if new:
                        met[digest] = ids[i]
                    parts.append(text.split() if new else [])
                sizes = np.array([len(p) if len(p) >= config.window else 0 for p in parts])
                flat = np.array([memo[w] for p in parts if len(p) >= config.window for w in p], np.uint64)
                memo.trim()
                owner = np.repeat(np.arange(len(parts)), sizes)
                begin = np.cumsum(sizes) - sizes
                start, count, key = minimizer_runs(flat, owner, config)
                rows = pa.array(owner[start] + first, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                     pa.array(start - begin[owner[start]], pa.int32()), pa.array(count, pa.int32())],
                    names=["key", "id", "text_hash", "start", "count"])
    return run


def pack_rows(batches):
    """Arrow function: texts compressed one by one, as they are moved twice."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        out = [squeeze(text) for _, texts in text_slices(batch) for text in texts]
        rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(out, pa.binary())],
                                         names=[*(n for n in batch.schema.names if n != "text"), "packed"])


def segment_rows(config: Config):
    """Contents of a document's runs, each with all its starts; a digest where the minimizer is hot."""
    def run(batches):
        names = ["key", "id", "text_hash", "starts", "count", "words", "digest"]
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids, hashes, packed, runs = batch.columns
            out, rows, size = ([], [], [], [], []), [], 0

            def flush():
                take = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), ids.take(take), hashes.take(take), pa.array(out[1], pa.list_(pa.int32())),
                     pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())], names=names)

            for i in range(batch.num_rows):
                words = open_(packed[i].as_py()).split()
                starts: dict[tuple, list] = {}
                for r in runs[i].as_py():
                    content = b" ".join(words[r["start"]:r["start"] + r["count"] + config.window - 1])
                    starts.setdefault((r["key"], r["count"], r["hot"], content), []).append(r["start"])
                for (key, count, hot, content), at in starts.items():
                    digest = xxhash.xxh3_128_digest(content) if hot else None
                    for column, value in zip(out, (key, at, count, content, digest)):
                        column.append(value)
                    rows.append(i)
                    size += len(content)
                if size > SEND_BYTES:
                    yield flush()
                    out, rows, size = ([], [], [], [], []), [], 0
            yield flush()
    return run


def window_rows(config: Config):
    """Runs to their windows, each as a digest."""
    def run(batches):
        for batch in batches:
            starts, digests, rows = [], [], []
            at, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, (begins, text) in enumerate(zip(at, texts)):
                words = text.split(b" ")
                for k in range(len(words) - config.window + 1):
                    starts.append([start + k for start in begins])
                    digests.append(xxhash.xxh3_128_digest(b" ".join(words[k:k + config.window])))
                    rows.append(i)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(np.ones(len(rows), np.int32)), pa.array(digests, pa.binary())],
                names=["id", "text_hash", "starts", "count", "digest"])
    return run


class BitRank:
    """A bit vector with ranks: 64 bits a block and one count per block."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) + 64) // 64 * 64, np.uint8)
        padded[:len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)])[:-1].astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.blocks[block] & mask)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector per bit of the alphabet."""

    def __init__(self, values: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.levels, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            self.levels.append(BitRank(bit))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        self.base = self.down(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for place, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = level.ones(at)
            set_ = ((symbols >> (self.bits - 1 - place)) & 1).astype(bool)
            at = np.where(set_, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self.down(symbols, at) - self.base[symbols]


class FMIndex:
    """FM-index of texts over word numbers (1 and up), for patterns of up to ``reach`` words.

    Suffixes are ordered by their first 64 symbols or more (ties by place), which makes
    backward search exact for patterns of that length.
    """

    def __init__(self, texts: list[np.ndarray], owners: np.ndarray, reach: int):
        sizes = np.array([len(t) + 1 for t in texts])
        text = np.zeros(int(sizes.sum()), np.int64)
        ends = np.cumsum(sizes)
        inside = np.ones(len(text), bool)
        inside[ends - 1] = False
        text[inside] = np.concatenate(texts)
        self.reach, self.size = reach, len(text)
        alphabet = int(text.max()) + 1

        def pairs(rank: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
            after = np.zeros(len(rank), np.int64)
            after[:max(0, len(rank) - gap)] = rank[gap:] + 1
            both = rank * (int(rank.max()) + 2) + after
            order = np.argsort(both, kind="stable")
            ranks = np.empty_like(rank)
            ranks[order] = np.concatenate([[0], np.cumsum(np.diff(both[order]) != 0)])
            return ranks, order

        rank, order, known, limit = text, None, 1, None
        while known < max(64, reach):
            if known * 2 > reach and limit is None:  # same first ``reach`` symbols
                limit = pairs(rank, reach - known)[0] if reach > known else rank
            rank, order = pairs(rank, known)
            known *= 2
        before = text[order - 1]
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.wavelet = WaveletMatrix(before, alphabet)
        # Groups of suffixes with the same first ``reach`` symbols, and the least owner in each.
        new = np.concatenate([[True], np.diff(limit[order]) != 0])
        self.group = np.cumsum(new) - 1
        self.group_start = np.flatnonzero(new)
        self.group_end = np.append(self.group_start[1:], self.size)
        owner_at = np.repeat(owners, sizes)[order]
        self.least_owner = np.minimum.reduceat(owner_at, self.group_start)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the intervals of each pattern with a symbol put before it."""
        at = self.wavelet.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        first = self.counts[symbols]
        return first + at[:len(low)], first + at[len(low):]

    def least_owners(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Per text and window of ``reach`` words the least owner of the window's occurrences (-1: none).

        All texts are streamed from their ends in step. The statistics never grow past
        ``reach``: a longer match is cut to its first ``reach`` words by the group it is in.
        Where a match cannot be extended, no window holds all of it and the word before it,
        so the search starts anew one word left of the match's end.
        """
        ends = np.cumsum([len(t) for t in texts])
        flat = np.concatenate(texts)
        begin = np.append(0, ends[:-1])
        owners = np.full(len(flat), -1, np.int64)
        live = np.flatnonzero(ends > begin)
        at = ends[live] - 1
        low, high = np.zeros(len(live), np.int64), np.full(len(live), self.size, np.int64)
        matched = np.zeros(len(live), np.int64)
        alphabet = len(self.counts) - 1
        while len(live):
            symbols = flat[at]
            known = symbols < alphabet
            low, high = self.extend(np.where(known, symbols, 0), low, high)
            gone = (high <= low) | ~known
            had, matched = matched, matched + 1
            long = matched > self.reach
            group = self.group[np.minimum(low, self.size - 1)]
            low, high = np.where(long, self.group_start[group], low), np.where(long, self.group_end[group], high)
            matched[long] = self.reach
            full = (matched == self.reach) & ~gone
            owners[at[full]] = self.least_owner[group[full]]
            if gone.any():
                at[gone] += had[gone]
                low[gone], high[gone], matched[gone] = 0, self.size, 0
            at = at - 1
            go = at >= begin[live]
            live, at, low, high, matched = live[go], at[go], low[go], high[go], matched[go]
        return [x[:max(0, len(x) - self.reach + 1)] for x in np.split(owners, ends[:-1])]


def spans(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of set flags that stay within one owner."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on
    new = np.ones(len(on), bool)
    new[1:] = (np.diff(on) != 1) | (owner[on[1:]] != owner[on[:-1]])
    start = np.flatnonzero(new)
    return on[start], np.diff(np.append(start, len(on)))


def search_shard(config: Config):
    """Arrow function over one shard: runs in, runs of removed windows out."""
    def run(table):
        numbers: dict[bytes, int] = {}
        ids = table.column("id").to_numpy()
        which, distinct, least = np.empty(len(ids), np.int64), {}, []
        for i, words in enumerate(table.column("words").to_pylist()):
            place = which[i] = distinct.setdefault(words, len(distinct))
            if place == len(least):
                least.append(ids[i])
            elif ids[i] < least[place]:
                least[place] = ids[i]
        texts = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in t.split(b" ")], np.int64) for t in distinct]
        owners = FMIndex(texts, np.array(least), config.window).least_owners(texts)
        counts = np.array([len(x) for x in owners])
        begin = np.cumsum(counts) - counts
        flat = np.concatenate(owners)
        size = counts[which]
        row = np.repeat(np.arange(len(ids)), size)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        at, length = spans(flat[begin[which[row]] + inner] < ids[row], row)
        take = pa.array(row[at])
        begins = table.column("starts").to_pylist()
        starts = [[start + offset for start in begins[i]] for i, offset in zip(row[at].tolist(), inner[at].tolist())]
        return pa.table({"id": table.column("id").take(take), "text_hash": table.column("text_hash").take(take),
                         "starts": pa.array(starts, pa.list_(pa.int32())), "count": pa.array(length, pa.int32())})
    return run


def repeated_windows(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     config: Config | None = None) -> DataFrame:
    """(id, text_hash, starts, count): runs of windows that also start in a document with a smaller id,
    each with all places it starts at.

    A document whose whole text has a smaller id's gets one run of ``ALL_WINDOWS``.
    """
    config = config or Config()
    bound_batches(documents.sparkSession)
    docs = (documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .filter("id IS NOT NULL").select("id", F.xxhash64("text").alias("text_hash"), "text"))
    # Whole copies: settled by the least id per text, pre-aggregated in every task.
    whole = docs.select("id", "text_hash", F.xxhash64(F.lit("second"), "text").alias("second"))
    text = ["text_hash", "second"]
    oldest = kept(whole.groupBy(*text).agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").drop("most"))
    copied = whole.join(oldest, text).filter("least < id").select(
        "id", "text_hash", F.array(F.lit(0)).alias("starts"), F.lit(ALL_WINDOWS).alias("count"))
    runs = docs.mapInArrow(lean(run_rows(config)), "key long, id long, text_hash long, start int, count int")
    # Held, not computed inside the join: so both sides of the join are shuffles, and Spark can split a hot key.
    met = kept(runs.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n"))
               .filter("least < most").select("key", (F.col("n") > config.hot).alias("hot")))
    lists = (runs.join(met, "key").groupBy("id", "text_hash")
             .agg(F.collect_set(F.struct("start", "count", "key", "hot")).alias("runs")))
    packed = docs.mapInArrow(lean(pack_rows), "id long, text_hash long, packed binary")
    segments = kept(packed.join(lists, ["id", "text_hash"]).select("id", "text_hash", "packed", "runs").mapInArrow(
        lean(segment_rows(config)), "key long, id long, text_hash long, starts array<int>, count int, words binary, digest binary"))
    run = ["id", "text_hash", "starts", "count"]

    # Hot minimizers: one row per content, the one with the least id.
    hot = segments.filter("digest IS NOT NULL")
    first = F.min(F.struct("id", "words", "count")).alias("first")
    contents = kept(hot.groupBy("key", "digest").agg(first).select(
        "key", "digest", F.col("first.id").alias("least"), "first.words", F.col("first.count").alias("windows")))
    crowded = contents.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > config.contents).select("key")
    narrow = hot.select("key", "digest", *run)
    copies = narrow.join(contents.select("key", "digest", "least"), ["key", "digest"]).filter("least < id").select(*run)
    firsts = narrow.join(contents.select("key", "digest", F.col("least").alias("id"), "words"), ["key", "digest", "id"])
    windows = firsts.join(crowded, "key", "left_semi").select("id", "text_hash", "starts", "words").mapInArrow(
        lean(window_rows(config)), "id long, text_hash long, starts array<int>, count int, digest binary")
    least = kept(windows.groupBy("digest").agg(F.min("id").alias("least")))
    single = windows.join(least, "digest").filter("least < id").select(*run)

    searched = (segments.filter("digest IS NULL").select("key", *run, "words")
                .unionByName(firsts.join(crowded, "key", "left_anti").select("key", *run, "words")))
    words = segments.filter("digest IS NULL").select((F.col("count") + config.window - 1).alias("n")).unionByName(
        contents.select((F.col("windows") + config.window - 1).alias("n"))).agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(words / config.shard_words))
    found = (searched.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
             .select("shard", *run, "words").groupBy("shard")
             .applyInArrow(lean_group(search_shard(config)), "id long, text_hash long, starts array<int>, count int"))
    return found.unionByName(copies).unionByName(single).unionByName(copied)


def kept_rows(config: Config):
    def run(batches):
        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            ids, packed, found = batch.columns
            begin, out, size = 0, ([], [], []), 0

            def flush(stop):
                return pa.RecordBatch.from_arrays(
                    [ids.slice(begin, stop - begin), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                     pa.array([x.decode("utf-8", "replace") for x in out[2]], pa.string())], names=["id", "n_words", "n_removed", "kept"])

            for i in range(batch.num_rows):
                words = kept_words = open_(packed[i].as_py()).split()
                if spans_ := found[i].as_py():
                    edge = np.zeros(len(words) + 1, np.int64)
                    starts = np.array([at for x in spans_ for at in x["starts"]])
                    counts = np.repeat([x["count"] for x in spans_], [len(x["starts"]) for x in spans_])
                    stops = np.minimum(starts + counts + config.window - 1, len(words))
                    whole = stops - starts >= config.window  # a text too short for a window loses nothing
                    np.add.at(edge, starts[whole], 1)
                    np.add.at(edge, stops[whole], -1)
                    kept_words = [w for w, k in zip(words, (np.cumsum(edge[:-1]) == 0).tolist()) if k]
                text = b" ".join(kept_words)
                for column, value in zip(out, (len(words), len(words) - len(kept_words), text)):
                    column.append(value)
                size += len(text)
                if size > SEND_BYTES:
                    yield flush(i + 1)
                    begin, out, size = i + 1, ([], [], []), 0
            yield flush(batch.num_rows)
    return run


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    config: Config | None = None) -> DataFrame:
    """Per document: id, n_words, n_removed, kept (the words left, joined by one space)."""
    config = config or Config()
    found = repeated_windows(documents, id_col, text_col, config)
    spans_ = (found.groupBy("id", "text_hash").agg(F.collect_list(F.struct("starts", "count")).alias("spans"))
              .select(F.col("id").alias("span_id"), F.col("text_hash").alias("span_hash"), "spans"))
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        lean(pack_rows), "id long, text_hash long, packed binary")
    met = docs.join(spans_, (F.col("id") == F.col("span_id")) & (F.col("text_hash") == F.col("span_hash")), "left")
    return met.select("id", "packed", "spans").mapInArrow(
        lean(kept_rows(config)), "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
