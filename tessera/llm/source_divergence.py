"""Source divergence audit: exact frequency filtering, then a recount through sharded minimal perfect hashes.

Terms are the runs of letters (A-Z, a-z, anything beyond ASCII), A-Z lower-cased. Pass 1 counts, per lang, the
documents that hold a term (pre-aggregated in the tasks, added up by Spark) and keeps the terms of at least
``min_docs`` documents, exactly.

The kept terms of a lang are dealt by hash to shards of about 16,000. Each shard gets a minimal perfect hash: levels
of bits, a term's bit at the first level where it is alone, its slot the rank of that bit; and the terms
themselves in slot order. The shards are published as files in the folder that driver and executors share, in
blocks of at most about 64 MB; a task holds one block at a time.

Pass 2 reads the texts again. A task counts terms per (lang, source), looks all of a shard's up at once,
compares each with the stored term of its slot (what is not kept falls out here), and adds to dense slots of
the (lang, source, shard). Dense slots leave a task as sparse integer arrays once they reach a fixed size. Where
the shards fit in one block, that is one scan with no shuffle of terms; beyond, term counts are first dealt to the
blocks. Spark adds the slots up.

Each (lang, shard) then is a small matrix, sources by slots: shares ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))`` in
integers, ``f = floor((p - q)^2 / (p + q))`` per pair of sources, summed over shards, and per source and term against
its lang, of which a shard hands on its first ``top`` alone. Integer steps keep shares exact up to N + 2 V = 9 x 10^15.

A pair row stands for each two sources of a lang, as the report is defined, so tables grow with the square of a
lang's sources; a matrix is taken in slices of bounded size.

NULL text, lang and source are the empty string. Every (lang, source) that occurs is a group, also without
terms; langs without kept terms give pairs of value 0. Repeated rows count as often as they occur, ids play no
part, ties of values are ordered by item. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import (bound_batches, delete_path, hash64, kept, lean, lean_group, release, saved, shared_path,
                                shuffle_partitions, text_slices)
from tessera.llm.token_files import filesystem

MIN_DOCS, TOP = 10, 10
SCALE_STEPS = (1000, 1000, 1000)    # their product is the scale of shares
SHARD_TERMS = 16_384
BLOCK_BYTES = 64 << 20
HELD_TERMS = 300_000                # distinct (group, term) counts a task holds before it hands them on
HELD_SLOTS = 8_000_000              # dense slots of 32 bits a task holds
HELD_TOKENS = 2 ** 31               # words added to them before they leave
MATRIX_CELLS = 2_000_000            # cells of a slice of (source, slot)
SEED = 42                           # of XXH64, as Spark's function has it
# Bytes to terms: A-Z lower-cased, a-z and all beyond ASCII as they are, the others to spaces.
TO_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

# lang, its terms, and per source: places of its terms in that list, their counts
Counts = tuple[str, list[bytes], list[tuple[str, np.ndarray, np.ndarray]]]


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TO_TERMS).split()


def utf8(terms: list[bytes]) -> pa.Array:
    return pa.array(terms, pa.binary()).cast(pa.string())


# Pass 1: exact document frequencies

def document_frequencies(batches):
    """Per task and lang: (lang, term, documents), handed on whenever enough are held."""
    held: dict[str, Counter] = {}

    def out():
        for lang, counts in held.items():
            terms = utf8(list(counts))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms), pa.string()), terms, pa.array(counts.values(), pa.int64())],
                                             ["lang", "term", "docs"])
        held.clear()

    for batch in batches:
        langs = batch.column(1).to_pylist()
        for start, texts in text_slices(batch):
            for lang, text in zip(langs[start:], texts):
                held.setdefault(lang, Counter()).update(set(terms_of(text)))
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from out()
    yield from out()


# Minimal perfect hashes

def level_places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (hash64(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n-1 for n terms. Terms whose 64-bit hash another term shares are the last slots."""

    def __init__(self, sizes: list[int], words: np.ndarray, terms: pa.Array):
        self.sizes, self.words, self.terms = sizes, words, terms
        ones = np.bitwise_count(words).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(ones)])
        n_bits = int(self.ranks[-1])
        self.shared = {t: n_bits + i for i, t in enumerate(terms.slice(n_bits).to_pylist())}

    @classmethod
    def build(cls, hashes: np.ndarray, terms: pa.Array) -> PerfectHash:
        """From terms that differ, and their hashes."""
        _, first, times = np.unique(hashes, return_index=True, return_counts=True)
        rest = own = np.sort(first[times == 1])
        sizes, words = [], []
        while len(rest):
            size = -(-2 * len(rest) // 64) * 64
            places = level_places(hashes[rest], len(sizes), size)
            alone = np.bincount(places, minlength=size)[places] == 1
            bits = np.zeros(size, np.uint8)
            bits[places[alone]] = 1
            sizes.append(size)
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            rest = rest[~alone]
        made = cls(sizes, np.concatenate(words) if words else np.zeros(0, np.uint64), terms.slice(0, 0))
        order = own[np.argsort(made.slots_of_hashes(hashes[own]))]
        shared = np.setdiff1d(np.arange(len(hashes)), own)
        return cls(sizes, made.words, terms.take(pa.array(np.concatenate([order, shared]))))

    def slots_of_hashes(self, hashes: np.ndarray) -> np.ndarray:
        slots, rest, base = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            places = base + level_places(hashes[rest], level, size)
            words, shifts = self.words[places >> 6], (places & 63).astype(np.uint64)
            hit = (words >> shifts & np.uint64(1)) > 0
            below = words[hit] & ((np.uint64(1) << shifts[hit]) - np.uint64(1))
            slots[rest[hit]] = self.ranks[places[hit] >> 6] + np.bitwise_count(below)
            rest, base = rest[~hit], base + size
            if not len(rest):
                break
        return slots

    def slots(self, hashes: np.ndarray, terms: pa.Array) -> np.ndarray:
        """Each term's slot; -1 where the stored term of the slot is another."""
        slots = self.slots_of_hashes(hashes)
        stored = self.terms.take(pa.array(slots, mask=slots < 0))
        same = pc.fill_null(pc.equal(stored, terms), False).to_numpy(zero_copy_only=False)
        slots[~same] = -1
        if self.shared:
            for i in np.flatnonzero(~same):
                slots[i] = self.shared.get(terms[i].as_py(), -1)
        return slots


SHARD = "lang string, shard long, block long, n long, sizes array<long>, words binary, terms array<string>"


def build_shard(table: pa.Table) -> pa.Table:
    made = PerfectHash.build(table.column("hash").to_numpy().view(np.uint64), table.column("term").combine_chunks())
    one = {c: table.column(c).slice(0, 1) for c in ("lang", "shard", "block")}
    return pa.table(one | {"n": [len(made.terms)], "sizes": pa.array([made.sizes], pa.list_(pa.int64())),
                           "words": pa.array([made.words.astype("<u8").tobytes()], pa.binary()),
                           "terms": pa.array([made.terms.to_pylist()], pa.list_(pa.string()))})


class Shards:
    """The published shards, one block held at a time."""

    def __init__(self, path: str):
        self.path, self.held = path, OrderedDict()

    def block(self, block: int) -> dict[tuple[str, int], PerfectHash]:
        if block not in self.held:
            self.held.clear()
            self.held[block] = self._load(block)
        return self.held[block]

    def _load(self, block: int) -> dict[tuple[str, int], PerfectHash]:
        fs, place = filesystem(f"{self.path}/block={block}")
        out = {}
        for info in fs.get_file_info(pafs.FileSelector(place, allow_not_found=True)):
            if not info.path.endswith(".parquet"):
                continue
            with fs.open_input_file(info.path) as file:
                for batch in pq.ParquetFile(file).iter_batches(batch_size=16):
                    columns = {c: batch.column(c) for c in ("lang", "shard", "sizes", "words", "terms")}
                    for i in range(batch.num_rows):
                        words = np.frombuffer(columns["words"][i].as_py(), "<u8").astype(np.uint64)
                        out[columns["lang"][i].as_py(), columns["shard"][i].as_py()] = PerfectHash(
                            columns["sizes"][i].as_py(), words, columns["terms"][i].values)
        return out


# Pass 2: the recount

def group_counts(batches) -> Iterator[Counts]:
    """Term counts of a task's texts by lang and source, handed on whenever enough are held."""
    held: dict[str, dict[str, Counter]] = {}
    n_bytes = 0

    def out():
        for lang, sources in held.items():
            places: dict[bytes, int] = {}
            parts = [(source, np.fromiter((places.setdefault(t, len(places)) for t in counts), np.int64, len(counts)),
                      np.fromiter(counts.values(), np.int64, len(counts))) for source, counts in sources.items()]
            yield lang, list(places), parts
        held.clear()

    for batch in batches:
        langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for start, texts in text_slices(batch):
            for lang, source, text in zip(langs[start:], sources[start:], texts):
                held.setdefault(lang, {}).setdefault(source, Counter()).update(terms_of(text))
                n_bytes += len(text)
            if n_bytes > HELD_TOKENS or sum(len(c) for by_source in held.values() for c in by_source.values()) > HELD_TERMS:
                yield from out()
                n_bytes = 0
    yield from out()


def term_hashes(terms: Iterable[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, SEED) for t in terms], np.uint64)


SLOTS = "lang string, source string, shard long, slots array<int>, counts array<long>"
DEALT = "block long, lang string, source string, terms array<string>, counts array<long>"


def segments(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, where it stands) of each distinct key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(keys[part[0]]), part


def parts_of(hashes: np.ndarray, modulus: int) -> np.ndarray:
    return (hashes % np.uint64(modulus)).astype(np.int64)


def added_up(counts: Iterable[Counts], path: str, shards: int, blocks: int):
    """Dense slots per (lang, source, shard), handed on as sparse arrays."""
    files, dense, size, times = Shards(path), {}, 0, 0

    def out():
        names, slots, values = list(dense), [np.flatnonzero(d).astype(np.int32) for d in dense.values()], list(dense.values())
        if names:
            ends = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n[0] for n in names], pa.string()), pa.array([n[1] for n in names], pa.string()), pa.array([n[2] for n in names], pa.int64()),
                 pa.ListArray.from_arrays(ends, np.concatenate(slots)),
                 pa.ListArray.from_arrays(ends, np.concatenate([d[s] for d, s in zip(values, slots)]).astype(np.int64))],
                ["lang", "source", "shard", "slots", "counts"])
        dense.clear()

    for lang, terms, parts in counts:
        # What all groups of a lang hold is looked up once.
        hashes, texts = term_hashes(terms), utf8(terms)
        shard_of, slots = parts_of(hashes, shards), np.full(len(terms), -1, np.int64)
        for shard, at in segments(shard_of):
            if (hashed := files.block(shard % blocks).get((lang, shard))) is not None:
                slots[at] = hashed.slots(hashes[at], texts.take(pa.array(at)))
        for source, places, numbers in parts:
            known = slots[places] >= 0
            places, numbers = places[known], numbers[known]
            for shard, at in segments(shard_of[places]):
                n_slots, tokens = len(files.block(shard % blocks)[lang, shard].terms), int(numbers[at].sum())
                if dense and (size + n_slots > HELD_SLOTS or times + tokens > HELD_TOKENS):
                    yield from out()
                    size = times = 0
                if (lang, source, shard) not in dense:
                    dense[lang, source, shard] = np.zeros(n_slots, np.uint32)
                    size += n_slots
                dense[lang, source, shard][slots[places[at]]] += numbers[at].astype(np.uint32)
                times += tokens
    yield from out()


def dealt(counts: Iterable[Counts], blocks: int):
    for lang, terms, parts in counts:
        block_of, texts = parts_of(term_hashes(terms), blocks), utf8(terms)
        for source, places, numbers in parts:
            for block, at in segments(block_of[places]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([lang], pa.string()), pa.array([source], pa.string()),
                     pa.array([texts.take(pa.array(places[at])).to_pylist()], pa.list_(pa.string())), pa.array([numbers[at]], pa.list_(pa.int64()))],
                    ["block", "lang", "source", "terms", "counts"])


def undealt(batches) -> Iterator[Counts]:
    for batch in batches:
        for i in range(batch.num_rows):
            terms = batch.column(3)[i].values.cast(pa.binary()).to_pylist()
            numbers = batch.column(4)[i].values.to_numpy(zero_copy_only=False)
            yield batch.column(1)[i].as_py(), terms, [(batch.column(2)[i].as_py(), np.arange(len(terms)), numbers)]


def recount(texts: DataFrame, path: str, shards: int, blocks: int) -> DataFrame:
    """(lang, source, shard, slot, n) with n > 0."""
    if blocks == 1:
        sparse = texts.mapInArrow(lean(lambda batches: added_up(group_counts(batches), path, shards, 1)), SLOTS)
    else:
        parts = shuffle_partitions(texts.sparkSession)
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(-(-parts // blocks)))
        sparse = (texts.mapInArrow(lean(lambda batches: dealt(group_counts(batches), blocks)), DEALT)
                  .repartition(parts, "block", salt).sortWithinPartitions("block")
                  .mapInArrow(lean(lambda batches: added_up(undealt(batches), path, shards, blocks)), SLOTS))
    return (sparse.select("lang", "source", "shard", F.inline(F.arrays_zip(F.col("slots").alias("slot"), F.col("counts").alias("n"))))
            .groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")))


# Divergences

def shares(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 n_terms)), by long division in steps that fit 64 bits."""
    below = total + 2 * n_terms
    if below > (2 ** 63 - 1) // max(SCALE_STEPS):
        raise OverflowError(f"{below} terms of a group: shares are exact up to {(2 ** 63 - 1) // max(SCALE_STEPS)}")
    # counts + 2 <= below, as counts add up to total.
    whole, rest = np.divmod(counts + 2, below)
    for step in SCALE_STEPS:
        digits, rest = np.divmod(rest * step, below)
        whole = whole * step + digits
    return whole + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


FOUND = "lang string, source string, part string, item string, value long"


def first_terms(values: np.ndarray, slots: np.ndarray, terms: pa.Array, top: int) -> list[tuple[str, int]]:
    """The ``top`` (term, value) with the largest values, ties by the terms' bytes."""
    if len(values) > top:
        bound = np.partition(values, len(values) - top)[len(values) - top]
        slots, values = slots[values >= bound], values[values >= bound]
    found = [(-int(v), terms[int(s)].as_py().encode()) for v, s in zip(values, slots)]
    return [(t.decode(), -v) for v, t in sorted(found)[:top]]


def divergences(counted: pa.Table, shard: pa.Table, top: int) -> pa.Table:
    """One (lang, shard): sums of f per pair of sources, and each source's first terms against the lang."""
    lang, n = shard.column("lang")[0].as_py(), shard.column("n")[0].as_py()
    profile = shard.column("profile")[0].as_py()
    n_terms, names, sizes = shard.column("n_terms")[0].as_py(), [s["source"] for s in profile], [s["size"] for s in profile]
    terms = shard.column("terms")[0].values
    at = pc.index_in(counted.column("source"), pa.array(names, pa.string())).to_numpy()
    slots, numbers = counted.column("slot").to_numpy(), counted.column("n").to_numpy()
    order = np.argsort(slots, kind="stable")
    at, slots, numbers = at[order], slots[order], numbers[order]
    sums = np.zeros((len(names), len(names)), np.int64)
    firsts: list[list[tuple[str, int]]] = [[] for _ in names]
    step = max(1, MATRIX_CELLS // len(names))
    for start in range(0, n, step):
        a, b = np.searchsorted(slots, [start, start + step])
        counts = np.zeros((len(names), min(step, n - start)), np.int64)
        counts[at[a:b], slots[a:b] - start] = numbers[a:b]
        p = np.stack([shares(row, size, n_terms) for row, size in zip(counts, sizes)])
        q = shares(counts.sum(axis=0), sum(sizes), n_terms)
        for i in range(len(names)):
            sums[i, i + 1:] += gaps(p[i + 1:], p[i]).sum(axis=1)
            over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
            found = first_terms(gaps(p[i, over], q[over]), start + over, terms, top)
            firsts[i] = sorted(firsts[i] + found, key=lambda x: (-x[1], x[0].encode()))[:top]
    sums += sums.T
    rows = [(s, "pair", t, int(sums[i, j])) for i, s in enumerate(names) for j, t in enumerate(names) if i != j]
    rows += [(s, "term", t, v) for s, found in zip(names, firsts) for t, v in found]
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), **{c: pa.array(v, pa.string()) for c, v in zip(("source", "part", "item"), columns)},
                     "value": pa.array(columns[3], pa.int64())})


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shard_terms: int = SHARD_TERMS,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per (lang, source): part ``pair`` with every other source of the lang, part ``term`` with the terms that set the
    source apart from its lang; item, value, rank."""
    spark = docs.sparkSession
    bound_batches(spark)
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    texts = docs.select(F.col("text").cast("string").alias("text"), filled("lang"), filled("source"))

    vocabulary = saved(texts.mapInArrow(lean(document_frequencies), "lang string, term string, docs long")
                       .groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs)
                       .select("lang", "term", F.xxhash64("term").alias("hash")), "terms")
    n_terms = kept(vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum(F.octet_length("term") + 16).alias("bytes")))
    most, n_bytes = n_terms.agg(F.max("n_terms"), F.sum("bytes")).first()
    blocks = 1 << max(0, -(-(n_bytes or 0) // block_bytes) - 1).bit_length()
    shards = max(blocks, 1 << max(0, -(-(most or 0) // shard_terms) - 1).bit_length())

    path = shared_path(spark, "perfect-hashes")
    (vocabulary.withColumn("shard", F.col("hash").bitwiseAND(F.lit(shards - 1)))
     .withColumn("block", F.col("shard").bitwiseAND(F.lit(blocks - 1)))
     .groupBy("lang", "shard").applyInArrow(lean_group(build_shard), SHARD)
     .repartition("block").write.partitionBy("block").parquet(path))
    hashed = spark.read.schema(SHARD).parquet(path)

    counted = kept(recount(texts, path, shards, blocks))
    sizes = (texts.select("lang", "source").distinct()
             .join(counted.groupBy("lang", "source").agg(F.sum("n").alias("size")), ["lang", "source"], "left")
             .select("lang", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size")))
    sizes = kept(sizes)
    profiles = sizes.groupBy("lang").agg(F.collect_list(F.struct("source", "size")).alias("profile"))
    about = hashed.join(n_terms.select("lang", "n_terms"), "lang").join(profiles, "lang").select(
        "lang", "shard", "n", "terms", "n_terms", "profile")
    found = counted.groupBy("lang", "shard").cogroup(about.groupBy("lang", "shard")).applyInArrow(
        lean_group(lambda left, right: divergences(left, right, top)), FOUND)
    other = sizes.select("lang", F.col("source").alias("item"))
    bare = (sizes.join(n_terms, "lang", "left_anti").join(other, "lang").filter("source <> item")
            .select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")))
    # A term is in one shard, so its sum is its value; a pair's sums come from every shard of the lang.
    values = found.unionByName(bare).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = saved(values.withColumn("rank", F.row_number().over(by_value)).filter((F.col("part") == "pair") | (F.col("rank") <= top)),
                   "divergence")
    for frame in (sizes, counted, n_terms, vocabulary):
        release(frame)
    delete_path(spark, path)
    return ranked
