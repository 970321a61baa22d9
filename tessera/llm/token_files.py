"""Token-id files: one concatenated id array per file, document boundaries in Elias-Fano form.

Documents are range-partitioned and sorted by id (NULL first; equal ids by text), each
task tokenizes its whole texts, appends the end id and streams ids into files of bounded
size. A file is

    ids        n_ids numbers of 2 or 4 bytes, little endian
    bounds     Elias-Fano of the n_docs + 1 boundaries (0 ... n_ids)
    keys       Elias-Fano of the non-NULL document ids, less the first one
    footer     FOOTER, fixed length, little endian

An Elias-Fano section keeps the low ``l = floor(log2(u / n))`` bits of each value packed,
the high parts as unary gaps in a bit vector, and the position of every 512th set bit, from
which ``select`` walks on: about 2 + log2(u/n) bits a value, no 64-bit offset table.

Files are named by attempt and listed by the frame the write returns, so a retried task
never leaves half a file in the result. NULL text is empty: its document holds the end id
alone. Repeated rows and ids are documents of their own, in a stable order. An empty table
gives no files. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import string
import struct
import sys
import types
import unicodedata
import uuid
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Memo, bound_batches, lean, shared_path, shuffle_partitions, text_slices

MAGIC = b"TSEFIDS1"
# magic, id width, documents, NULL ids, ids, first key, bounds (offset, universe), keys (offset, universe)
FOOTER = "<8sIQQQqQQQQ"
SAMPLE = 512                     # every 512th set bit has its position kept
FILE_IDS = 1 << 27               # ids in a file, about, at most
ENCODE_BYTES = 6 << 20           # text encoded at a time: a word is looked up once in it
# The letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from 256 on.
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}


@dataclass
class EliasFano:
    """A non-decreasing sequence of ``n`` numbers from 0 to ``universe``."""
    n: int
    universe: int
    low: np.ndarray          # packed low bits, bytes
    high: np.ndarray         # bit vector, bytes, least bit first
    samples: np.ndarray      # position of every SAMPLE-th set bit, 4 bytes each

    @staticmethod
    def low_bits(n: int, universe: int) -> int:
        return max(0, (universe // n).bit_length() - 1) if n else 0

    @classmethod
    def sizes(cls, n: int, universe: int) -> tuple[int, int, int]:
        bits = cls.low_bits(n, universe)
        return (n * bits + 7) // 8, ((universe >> bits) + n + 8) // 8 if n else 0, 4 * -(-n // SAMPLE)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n, bits = len(values), cls.low_bits(len(values), universe)
        low_len, high_len, _ = cls.sizes(n, universe)
        low = np.zeros(low_len, np.uint8)
        if bits and n:
            places = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            low = np.packbits(places.ravel(), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        marks = np.zeros(high_len * 8, np.uint8)
        marks[ones] = 1
        return cls(n, universe, low, np.packbits(marks, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def tobytes(self) -> bytes:
        return self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def frombytes(cls, data: bytes, n: int, universe: int) -> EliasFano:
        a, b, c = cls.sizes(n, universe)
        raw = np.frombuffer(data, np.uint8, a + b + c)
        return cls(n, universe, raw[:a], raw[a:a + b], np.frombuffer(data, "<u4", c // 4, a + b))

    def select(self, i: int) -> int:
        """Position of the i-th set bit: from the kept sample on, by counting bytes."""
        at = int(self.samples[i // SAMPLE])
        rest = i % SAMPLE
        byte, first = at // 8, at % 8
        window = int(self.high[byte]) >> first << first
        while (have := window.bit_count()) <= rest:
            rest -= have
            byte += 1
            window = int(self.high[byte])
        for _ in range(rest):
            window &= window - 1
        return byte * 8 + (window & -window).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        bits = self.low_bits(self.n, self.universe)
        low, start = 0, i * bits
        if bits:
            span = self.low[start // 8:(start + bits + 7) // 8].tobytes()
            low = (int.from_bytes(span, "little") >> (start % 8)) & ((1 << bits) - 1)
        return ((self.select(i) - i) << bits) | low

    def all(self) -> np.ndarray:
        """The whole sequence at once."""
        bits = self.low_bits(self.n, self.universe)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(bits)
        if bits and self.n:
            places = np.unpackbits(self.low, bitorder="little")[:self.n * bits].reshape(self.n, bits).astype(np.uint64)
            out |= (places << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out.astype(np.int64)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or plain path, as tasks see them."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Writer:
    """Streams documents into one file."""

    def __init__(self, path: str, width: int):
        fs, self.place = filesystem(path)
        fs.create_dir(os.path.dirname(self.place), recursive=True)
        self.path, self.width, self.out = path, width, fs.open_output_stream(self.place)
        self.keys, self.nulls, self.bounds = [], 0, [0]

    def add(self, key: int | None, ids: bytes) -> None:
        """``ids``: 4-byte little-endian numbers."""
        if key is None:
            self.nulls += 1
        else:
            self.keys.append(key)
        self.bounds.append(self.bounds[-1] + len(ids) // 4)
        self.out.write(ids if self.width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())

    def close(self) -> tuple[str, int, int]:
        total, docs = self.bounds[-1], len(self.bounds) - 1
        first = self.keys[0] if self.keys else 0
        keys = np.array(self.keys, np.int64) - first if self.keys else np.zeros(0, np.int64)
        reach = int(keys[-1]) if len(keys) else 0
        bounds = EliasFano.of(np.array(self.bounds, np.int64), total).tobytes()
        at = total * self.width
        self.out.write(bounds)
        self.out.write(EliasFano.of(keys, reach).tobytes())
        self.out.write(struct.pack(FOOTER, MAGIC, self.width, docs, self.nulls, total, first, at, total, at + len(bounds), reach))
        self.out.close()
        return self.path, docs, total


class TokenFile:
    """Random access to one file by range reads."""

    def __init__(self, path: str):
        fs, place = filesystem(path)
        self.file = fs.open_input_file(place)
        size, footer = self.file.size(), struct.calcsize(FOOTER)
        (magic, self.width, self.docs, self.nulls, self.total, first, bounds_at, bounds_reach, keys_at,
         keys_reach) = struct.unpack(FOOTER, self.file.read_at(footer, size - footer))
        if magic != MAGIC:
            raise ValueError(f"no token file: {path}")
        section = self.file.read_at(size - footer - bounds_at, bounds_at)
        self.bounds = EliasFano.frombytes(section, self.docs + 1, bounds_reach)
        self.keys = EliasFano.frombytes(section[keys_at - bounds_at:], self.docs - self.nulls, keys_reach)
        self.first = first

    def ids(self, start: int, stop: int) -> np.ndarray:
        raw = self.file.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(raw, "<u4" if self.width == 4 else "<u2")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.bounds[i], self.bounds[i + 1])

    def key(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.keys[i - self.nulls]

    def close(self) -> None:
        self.file.close()


def worker_cache(key, make):
    """Kept by a Python worker from task to task."""
    home = sys.modules.setdefault("tessera_worker_cache", types.ModuleType("tessera_worker_cache"))
    if key not in home.__dict__:
        home.__dict__[key] = make()
    return home.__dict__[key]


class Encoder:
    """Whole texts to ids by the tokenizers library.

    ``per_word``: for vocabularies that fold case, drop white space, never look across it,
    split letters from punctuation and mark the last piece of each such part with ``</w>``.
    The ids of a text are then the ids of its words in turn, and those of plain words the
    ids of their letters and of the ASCII marks behind them; any other word is encoded as it stands. Where the
    tokenizer's settings are those stated here, letters go to its model at once.
    """

    UNEVEN = set("ΣİıſK")   # letters whose lower case hangs on their place or is no single letter

    def __init__(self, path: str, per_word: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.per_word = per_word
        self.model = self.tokenizer.model if self.folds_as_known() else None  # for parts that need no other step
        self.words: dict[bytes, bytes] = {}   # those that are not plain ASCII
        self.parts = Memo(lambda part: self.bytes_of([part])[0], 400_000)
        largest = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.width = 2 if largest < 1 << 16 else 4

    # The steps under which the ids of plain, folded parts are those of the model alone.
    NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def folds_as_known(self) -> bool:
        """Whether the tokenizer's own settings are those steps: fold, cut at white space into runs of letters, digits
        and marks, and give each run to a model that marks its last piece and has no rules of its own besides."""
        made = json.loads(self.tokenizer.to_str())
        cut, as_bytes = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])[:2]
        model = made["model"]
        return ((made["normalizer"] or {}).get("normalizers") == self.NORMAL
                and cut.get("type") == "Split" and cut["pattern"] == {"Regex": self.PIECES} and cut["invert"] and cut["behavior"] == "Removed"
                and as_bytes.get("type") == "ByteLevel" and not as_bytes["add_prefix_space"] and not as_bytes["use_regex"]
                and model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>"
                and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges")))

    def bytes_of(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in got]

    def split(self, raw: bytes) -> tuple[str, str] | None:
        """(letters in lower case, marks) of a plain word beyond ASCII."""
        if raw.isascii():
            return None
        word = raw.decode("utf-8", "replace")
        letters = word.rstrip(string.punctuation)
        mark = word[len(letters):]
        if not letters.isalpha():
            return None
        low = letters.lower()
        even = unicodedata.is_normalized("NFC", letters) and self.UNEVEN.isdisjoint(letters)
        return (low, mark) if even and low.isalpha() and unicodedata.is_normalized("NFC", low) else None

    def learn(self, parts: list[str]) -> None:
        """Ids of lower-case letters: straight from the model, their bytes as the letters it knows them by."""
        if self.model is None:
            for at in range(0, len(parts), 1_000):
                some = parts[at:at + 1_000]
                self.parts.update(zip(some, self.bytes_of(some)))
            return
        tokenize = self.model.tokenize
        for part in parts:
            known = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_LETTERS)
            self.parts[part] = array("I", [t.id for t in tokenize(known)]).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.per_word:
            return [x for at in range(0, len(texts), 64)
                    for x in self.bytes_of([t.decode("utf-8", "replace") for t in texts[at:at + 64]])]
        # Words as numbers into the slice's distinct ones, told apart by Arrow: what is there already is no Python
        # object. A text that begins or ends in white space has an empty first or last word, of no ids.
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        coded = lists.flatten().dictionary_encode()
        pool, sizes = self.ids_of(coded.dictionary)
        ids, ends = gathered(pool, sizes, coded.indices.to_numpy())
        raw, cuts = ids.tobytes(), (ends[lists.offsets.to_numpy()] * 4).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def ids_of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of them) of distinct words in turn."""
        words, parts = self.words, self.parts
        if len(words) > 200_000:
            words.clear()
        parts.trim()
        # ASCII letters and the marks behind them are cut by Arrow as well, and the distinct letters looked up.
        letters = pc.ascii_rtrim(distinct, characters=string.punctuation)
        plain = pc.ascii_is_alpha(letters).to_numpy(zero_copy_only=False)
        at = pa.array(np.flatnonzero(plain))
        low = pc.ascii_lower(letters.take(at)).dictionary_encode()
        marks = pc.ascii_ltrim(distinct.take(at), characters=string.ascii_letters).dictionary_encode()
        low_parts, mark_parts = low.dictionary.to_pylist(), marks.dictionary.to_pylist()
        others = distinct.filter(pa.array(~plain)).view(pa.binary()).to_pylist()

        new = [w for w in others if w not in words]
        found = [self.split(w) for w in new]
        self.learn([p for p in {*low_parts, *(f[0] for f in found if f)} if p not in parts])
        words.update((w, parts[f[0]] + parts[f[1]] if f[1] else parts[f[0]]) for w, f in zip(new, found) if f)
        odd = [w for w, f in zip(new, found) if not f]
        for start in range(0, len(odd), 1_000):
            some = odd[start:start + 1_000]
            words.update(zip(some, self.bytes_of([w.decode("utf-8", "replace") for w in some])))

        pieces = [*(parts[p] for p in low_parts), *(parts[m] if m else b"" for m in mark_parts), *(words[w] for w in others), b""]
        pool, sizes = np.frombuffer(b"".join(pieces), "<u4"), np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        # Two pieces a word: letters and marks, or the whole word and nothing.
        two = np.empty((len(plain), 2), np.int64)
        two[plain, 0], two[plain, 1] = low.indices.to_numpy(), len(low_parts) + marks.indices.to_numpy()
        two[~plain, 0], two[~plain, 1] = len(low_parts) + len(mark_parts) + np.arange(len(others)), len(pieces) - 1
        ids, ends = gathered(pool, sizes, two.ravel())
        return ids, ends[2::2] - ends[:-1:2]


def gathered(pool: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends): the runs ``codes`` of a pool of runs of ``sizes``, one after the other, and where each begins."""
    lengths = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return pool[np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], lengths) + np.arange(ends[-1])], ends


def encode_files(folder: str, tokenizer: str, end_id: int, per_word: bool, file_ids: int):
    end = struct.pack("<I", end_id)

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        done, writer = [], None
        for batch in batches:
            encoder = worker_cache((tokenizer, per_word), lambda: Encoder(tokenizer, per_word))
            keys = batch.column(0).to_pylist()
            for first, texts in text_slices(batch, size=ENCODE_BYTES):
                for i, ids in enumerate(encoder.encode(texts)):
                    if writer is not None and writer.bounds[-1] >= file_ids:
                        done.append(writer.close())
                        writer = None
                    if writer is None:
                        writer = Writer(f"{folder}/part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.ids", encoder.width)
                    writer.add(keys[first + i], ids + end)
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(done), pa.int64()), pa.array(range(len(done)), pa.int64()),
             pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], names=["part", "number", "path", "docs", "ids"])
    return run


def write_token_files(documents: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id",
                      text_col: str = "text", per_word: bool = False, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the files; one row per file in order: part, number, path, docs, ids, start (ids of all files before)."""
    spark = documents.sparkSession
    bound_batches(spark)
    folder = folder or shared_path(spark, "ids")
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # The row number deals out even an id that many rows share.
    docs = docs.withColumn("row", F.monotonically_increasing_id())
    dealt = (docs.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text"), "row")
             .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text").drop("row"))
    listed = dealt.mapInArrow(lean(encode_files(folder, tokenizer, end_id, per_word, file_ids)),
                              "part long, number long, path string, docs long, ids long")
    rows, start = [], 0
    for r in sorted(listed.collect()):  # the one job that writes; one short row per file
        rows.append((*r, start))
        start += r["ids"]
    return spark.createDataFrame(rows, "part long, number long, path string, docs long, ids long, start long")


def read_token_files(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, start, n_tokens, ids_crc32 (of the ids as 4-byte numbers)."""
    def run(batches):
        for batch in batches:
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(path)
                bounds = file.bounds.all()
                keys = file.keys.all() + file.first
                for at in range(0, file.docs, 10_000):
                    stop = min(file.docs, at + 10_000)
                    crcs, i = [], at
                    while i < stop:  # read several documents at once, long ones by themselves
                        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + (1 << 20), "right")) - 1)
                        j = min(j, stop)
                        ids = file.ids(int(bounds[i]), int(bounds[j])).astype("<u4")
                        cut = (bounds[i:j + 1] - bounds[i]).tolist()
                        crcs += [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cut, cut[1:])]
                        i = j
                    own = [None if k < file.nulls else int(keys[k - file.nulls]) for k in range(at, stop)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64()), pa.array(bounds[at:stop] + begin, pa.int64()),
                         pa.array(np.diff(bounds[at:stop + 1]), pa.int64()), pa.array(crcs, pa.int64())],
                        names=[id_col, "start", "n_tokens", "ids_crc32"])
                file.close()

    # The rows are short but stand for much data: a stated number of parts is not merged.
    spread = files.select("path", "start").repartition(shuffle_partitions(files.sparkSession), F.col("path"))
    return spread.mapInArrow(lean(run), f"{id_col} long, start long, n_tokens long, ids_crc32 long")
