"""Language-model scores by a hidden Markov model over word classes.

Tokens are lower-cased (A-Z) words and one end per document. Every token has a class: the
end its own, words ``classes`` hashed ones. The model draws a state sequence, from each
state a class, and the word from its class by its smoothed share of the class's training
tokens: P(w | class) = (c + 1) / (tokens of the class + words of the class + 1), where one
unseen word per class is allowed for. So the hidden parameters stay of fixed size while the
vocabulary and its counts grow with the corpus.

1. Count. Each task numbers the words of a *chunk* of documents (a few million tokens),
   keeps the documents as compressed numbers and classes, and counts training tokens.
   The words of a chunk are dealt by hash into buckets, a compressed block per bucket, so
   counts are shuffled pre-aggregated and packed; a word has one entry per chunk at most,
   so no word is hot. Buckets double with the input's bytes. Only counts of words
   that several chunks share go back to the chunks.
2. Train. Baum-Welch over all training documents: tasks run the scaled forward-backward
   recursion over many pieces of documents at a time and return expected counts, which
   Spark sums by class; the driver renews parameters of fixed size. Later pieces of a
   document start from the stationary distribution.
3. Score. The scaled forward recursion runs over whole documents, long ones too, and gives
   the exact likelihood of the class sequence; the words' shares are added.

``base_score`` is the add-one unigram score. Documents whose fold is not held out are
learned from (NULL ids too). NULL and empty texts are their end alone. Repeated rows are
rows like others. Without training tokens both scores are base scores of unseen tokens.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, id_fold, input_bytes, kept, lean, lean_group, text_slices

END = b"\n"   # no word can hold white space


@dataclass
class Config:
    states: int = 6
    classes: int = 8_192          # hashed word classes, at most 65,534
    rounds: int = 8
    piece: int = 256              # tokens of a training sequence
    chunk: int = 4_000_000        # tokens numbered together, about
    buckets: int = 1_024          # parts the vocabulary is counted in, at least
    bucket_bytes: int = 16 << 20  # of input whose words a bucket takes, about
    batch: int = 1_000_000        # tokens held at once in a recursion, about
    stay: float = 0.9
    smoothing: float = 0.1
    folds: int = 7
    held_out: int = 2
    seed: int = 10


class Numbering(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def packed(values: np.ndarray, kind: str) -> bytes:
    """Numbers compressed by byte planes: the upper bytes of small numbers are alike."""
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def sums_by(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each run of ``sizes`` values; runs are never empty."""
    return np.add.reduceat(values, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)


def word_hash(word: bytes) -> int:
    return zlib.crc32(word)


def class_of(word: bytes, classes: int) -> int:
    return classes if word == END else word_hash(word) % classes


CHUNK_ROWS = ("chunk long, number int, id long, held_out boolean, n_tokens long, known long, log_counts double, "
              "ids binary, classes binary, bucket int, words binary, counts binary")


def count_chunks(config: Config, buckets: int):
    """Documents as numbers and classes, and the words of each chunk by bucket, as rows of one table."""
    names = [x.split()[0] for x in CHUNK_ROWS.split(", ")]

    def close(chunk, table, docs):
        sizes = np.array([len(d[2]) for d in docs])
        flat = np.concatenate([d[2] for d in docs])
        learn = np.repeat(np.array([not d[1] for d in docs]), sizes)
        counts = np.bincount(flat[learn], minlength=len(table))
        words = list(table)
        of_word = np.array([class_of(w, config.classes) for w in words], np.uint16)
        known, logs = sums_by((counts > 0)[flat].astype(np.int64), sizes), sums_by(np.log10(counts + 1.0)[flat], sizes)
        flat_classes, at = of_word[flat], np.concatenate([[0], np.cumsum(sizes)])
        blank = lambda kind, size: pa.nulls(size, kind)
        for i in range(0, len(docs), 2_000):
            some, n = docs[i:i + 2_000], len(docs[i:i + 2_000])
            spans = list(zip(at[i:i + n].tolist(), at[i + 1:i + n + 1].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, chunk)), pa.array(np.arange(i, i + n), pa.int32()), pa.array([d[0] for d in some], pa.int64()),
                 pa.array([d[1] for d in some]), pa.array(sizes[i:i + n], pa.int64()), pa.array(known[i:i + n], pa.int64()),
                 pa.array(logs[i:i + n], pa.float64()), pa.array([packed(flat[a:b], "<u4") for a, b in spans], pa.binary()),
                 pa.array([packed(flat_classes[a:b], "<u2") for a, b in spans], pa.binary()),
                 blank(pa.int32(), n), blank(pa.binary(), n), blank(pa.binary(), n)], names=names)
        bucket = np.array([word_hash(w) % buckets for w in words])
        order = np.argsort(bucket, kind="stable")
        starts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
        squeeze = zstandard.ZstdCompressor(level=3).compress
        out = ([], [], [])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            own = order[a:b]
            out[0].append(int(bucket[own[0]]))
            out[1].append(squeeze(b" ".join([words[k] for k in own.tolist()])))
            out[2].append(packed(np.concatenate([own, counts[own]]), "<u4"))
        k = len(out[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, chunk)), *(blank(t, k) for t in (pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
                                                                  pa.float64(), pa.binary(), pa.binary())),
             pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], names=names)

    def run(batches):
        from pyspark import TaskContext
        part, chunk = TaskContext.get().partitionId(), 0
        table, docs, tokens = Numbering(), [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            held = batch.column(1).to_pylist()
            for first, texts in text_slices(batch):
                for i, text in enumerate(texts, first):
                    words = text.lower().split()
                    words.append(END)
                    docs.append((ids[i], held[i], np.array([table[w] for w in words], np.int32)))
                    tokens += len(words)
                    if tokens >= config.chunk:
                        yield from close((part << 32) | chunk, table, docs)
                        chunk += 1
                        table, docs, tokens = Numbering(), [], 0
        if docs:
            yield from close((part << 32) | chunk, table, docs)
    return run


def count_bucket(config: Config):
    """Arrow function over one bucket: totals per class, and per chunk the totals of words it shares with others."""
    def run(table):
        numbering, places, numbers, counts = Numbering(), [], [], []
        open_ = zstandard.ZstdDecompressor().decompress
        for words, data in zip(table.column("words").to_pylist(), table.column("counts").to_pylist()):
            places.append(np.array([numbering[w] for w in open_(words).split(b" ")], np.int64))
            both = unpacked(data, "<u4")
            numbers.append(both[:len(both) // 2])
            counts.append(both[len(both) // 2:])
        every = np.concatenate(places)
        total = np.bincount(every, np.concatenate(counts), len(numbering)).astype(np.int64)
        shared = np.bincount(every, minlength=len(numbering)) > 1
        seen = total > 0
        classes = np.array([class_of(w, config.classes) for w in numbering], np.int64)[seen]
        found = np.unique(classes)
        tokens = np.bincount(classes, total[seen], config.classes + 1).astype(np.int64)[found]
        kinds = np.bincount(classes, minlength=config.classes + 1)[found]
        chunks, blocks = [], []
        for chunk, place, number, count in zip(table.column("chunk").to_pylist(), places, numbers, counts):
            own = shared[place]
            if own.any():
                chunks.append(chunk)
                blocks.append(packed(np.concatenate([number[own].astype(np.uint64), count[own].astype(np.uint64),
                                                     total[place[own]].astype(np.uint64)]), "<u8"))
        n, m = len(found), len(chunks)
        return pa.table({"class": pa.concat_arrays([pa.array(found, pa.int32()), pa.nulls(m, pa.int32())]),
                         "tokens": pa.concat_arrays([pa.array(tokens, pa.int64()), pa.nulls(m, pa.int64())]),
                         "kinds": pa.concat_arrays([pa.array(kinds, pa.int64()), pa.nulls(m, pa.int64())]),
                         "word_chunk": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(chunks, pa.int64())]),
                         "shared": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(blocks, pa.binary())])})
    return run


@dataclass
class Model:
    start: np.ndarray      # (states)
    move: np.ndarray       # (states, states)
    emit: np.ndarray       # (classes + 1, states)

    def stationary(self) -> np.ndarray:
        at = np.full(len(self.start), 1 / len(self.start))
        for _ in range(200):
            at = at @ self.move
        return at / at.sum()


def first_model(totals: np.ndarray, config: Config) -> Model:
    """Unlike states: each weighs the classes' training shares by fixed random factors."""
    rng = np.random.default_rng(config.seed)
    share = (totals + config.smoothing) / (totals + config.smoothing).sum()
    emit = share[:, None] * rng.exponential(size=(len(totals), config.states))
    move = np.full((config.states, config.states), (1 - config.stay) / max(1, config.states - 1))
    np.fill_diagonal(move, config.stay if config.states > 1 else 1.0)
    return Model(np.full(config.states, 1 / config.states), move, emit / emit.sum(axis=0))


def forward_scores(docs: list[np.ndarray], model: Model) -> np.ndarray:
    """Exact log10 likelihood of whole class sequences, longest first, all at once step by step."""
    sizes = np.array([len(d) for d in docs])
    order = np.argsort(-sizes, kind="stable")
    flat, begin = np.concatenate(docs), np.cumsum(sizes) - sizes
    begin, live = begin[order], np.searchsorted(-sizes[order], -np.arange(sizes.max()), "left")
    total = np.zeros(len(docs))
    alpha = None
    for step, m in enumerate(live):
        seen = model.emit[flat[begin[:m] + step]]
        alpha = seen * (model.start if alpha is None else alpha[:m] @ model.move)
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        total[:m] += np.log10(scale)
    out = np.empty(len(docs))
    out[order] = total
    return out


def expected_counts(pieces: list[np.ndarray], first: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch: expected (emissions, moves, starts) of equal-handled pieces, and their log likelihood."""
    states = len(model.start)
    sizes = np.array([len(p) for p in pieces])
    order = np.argsort(-sizes, kind="stable")
    flat, begin = np.concatenate(pieces), np.cumsum(sizes) - sizes
    begin, first = begin[order], first[order]
    live = np.searchsorted(-sizes[order], -np.arange(sizes.max()), "left")
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    begins = np.where(first[:, None], model.start, model.stationary()).astype(np.float32)
    alphas, scales, seens, places = [], [], [], []
    likelihood = 0.0
    for step, m in enumerate(live):
        at = flat[begin[:m] + step]
        seen = emit[at]
        alpha = seen * (begins if step == 0 else alphas[-1][:m] @ move)
        scale = alpha.sum(axis=1, keepdims=True)
        alpha /= scale
        likelihood += float(np.log10(scale, dtype=np.float64).sum())
        alphas.append(alpha)
        scales.append(scale)
        seens.append(seen)
        places.append(at)
    moves = np.zeros((states, states))
    gammas = [None] * len(live)
    beta = np.ones((live[-1], states), np.float32)
    gammas[-1] = alphas[-1]
    for step in range(len(live) - 2, -1, -1):
        m, n = live[step], live[step + 1]
        back = seens[step + 1] * beta / scales[step + 1]
        moves += (alphas[step][:n].T @ back).astype(np.float64)
        new = np.ones((m, states), np.float32)
        new[:n] = back @ move.T
        beta = new
        gammas[step] = alphas[step] * beta
    moves *= model.move
    place, gamma = np.concatenate(places), np.concatenate(gammas)
    emissions = np.stack([np.bincount(place, gamma[:, k], len(emit)) for k in range(states)], axis=1)
    return emissions, moves, gammas[0][first].sum(axis=0, dtype=np.float64), likelihood


def count_rows(model: Model, config: Config):
    """Arrow function: expected counts of a task; rows past the classes hold moves, starts and likelihood."""
    def run(batches):
        size, states = len(model.emit), config.states
        total = np.zeros((size + states + 2, states))

        def add(pieces, first):
            emissions, moves, starts, likelihood = expected_counts(pieces, np.array(first), model)
            total[:size] += emissions
            total[size:size + states] += moves
            total[size + states] += starts
            total[size + states + 1, 0] += likelihood

        pieces, first, tokens = [], [], 0
        for batch in batches:
            for data in batch.column(0).to_pylist():
                doc = unpacked(data, "<u2")
                for at in range(0, len(doc), config.piece):
                    pieces.append(doc[at:at + config.piece])
                    first.append(at == 0)
                    tokens += len(pieces[-1])
                    if tokens >= config.batch:
                        add(pieces, first)
                        pieces, first, tokens = [], [], 0
        if pieces:
            add(pieces, first)
        rows = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *(pa.array(total[rows, k].astype(np.float32)) for k in range(states))],
                                         names=["row", *(f"s{k}" for k in range(states))])
    return run


def train(sequences: DataFrame, totals: np.ndarray, config: Config) -> tuple[Model, list[float]]:
    """Baum-Welch rounds; the driver sees parameters only."""
    model, size, states = first_model(totals, config), len(totals), config.states
    schema = "row int, " + ", ".join(f"s{k} float" for k in range(states))
    prior = (totals + 1) / (totals + 1).sum()
    likelihoods = []
    for _ in range(config.rounds):
        got = np.zeros((size + states + 2, states))
        summed = (sequences.select("classes").mapInArrow(lean(count_rows(model, config)), schema)
                  .groupBy("row").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(states))))
        for r in summed.collect():
            got[r["row"]] = r[1:]
        emit = got[:size] + config.smoothing * size * prior[:, None]
        move = got[size:size + states] + 1
        start = got[size + states] + 1
        likelihoods.append(float(got[-1, 0]))
        model = Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model, likelihoods


def corrections(table, blocks):
    """One chunk: its documents' sums, corrected for the words it shares with other chunks."""
    if not table.num_rows:
        return pa.table({"chunk": pa.array([], pa.int64()), "number": pa.array([], pa.int32()),
                         "log_counts": pa.array([], pa.float64()), "n_known": pa.array([], pa.int64())})
    docs = [unpacked(x, "<u4") for x in table.column("ids").to_pylist()]
    logs, known = table.column("log_counts").to_numpy().copy(), table.column("known").to_numpy().copy()
    if blocks.num_rows:
        size = max(int(d.max()) for d in docs) + 1
        delta, newly = np.zeros(size), np.zeros(size, np.int64)
        for data in blocks.column("shared").to_pylist():
            place, own, every = unpacked(data, "<u8").reshape(3, -1).astype(np.int64)
            delta[place] = np.log10(every + 1.0) - np.log10(own + 1.0)
            newly[place] = (every > 0) & (own == 0)
        for i, doc in enumerate(docs):
            logs[i] += delta[doc].sum()
            known[i] += newly[doc].sum()
    return pa.table({"chunk": table.column("chunk"), "number": table.column("number"),
                     "log_counts": pa.array(logs), "n_known": pa.array(known, pa.int64())})


def score_rows(model: Model, class_logs: np.ndarray, config: Config):
    """Arrow function: log10 likelihood of the classes, less the log10 of the classes' denominators."""
    def run(batches):
        for batch in batches:
            data = batch.column(batch.schema.get_field_index("classes")).to_pylist()
            scores, docs, tokens = [], [], 0

            def flush():
                sizes = np.array([len(d) for d in docs])
                scores.append(forward_scores(docs, model) - sums_by(class_logs[np.concatenate(docs)], sizes))

            for i, one in enumerate(data):
                docs.append(unpacked(one, "<u2"))
                tokens += len(docs[-1])
                if tokens >= 4 * config.batch or i == len(data) - 1:
                    flush()
                    docs, tokens = [], 0
            names = [n for n in batch.schema.names if n != "classes"]
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                             names=[*names, "path_score"])
    return run


@dataclass
class Scored:
    frame: DataFrame
    model: Model | None
    likelihoods: list[float]


def language_model(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: Config | None = None) -> Scored:
    """Train on the learning folds and score every document. See the module docstring."""
    config = config or Config()
    bound_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).cast("long").alias("id"),
                            (id_fold(F.col(id_col), config.folds) == config.held_out).alias("held_out"),
                            F.col(text_col).cast("string").alias("text"))
    buckets = config.buckets
    while buckets * config.bucket_bytes < input_bytes(documents):
        buckets *= 2
    table = kept(docs.mapInArrow(lean(count_chunks(config, buckets)), CHUNK_ROWS))
    rows, words = table.filter("n_tokens IS NOT NULL"), table.filter("bucket IS NOT NULL")
    counted = kept(words.select("bucket", "chunk", "words", "counts").groupBy("bucket").applyInArrow(
        lean_group(count_bucket(config)), "class int, tokens long, kinds long, word_chunk long, shared binary"))
    totals, vocabulary = np.zeros(config.classes + 1), np.zeros(config.classes + 1)
    for r in (counted.filter("class IS NOT NULL").groupBy("class")
              .agg(F.sum("tokens").alias("n"), F.sum("kinds").alias("v")).collect()):  # a row per class
        totals[r["class"]], vocabulary[r["class"]] = r["n"], r["v"]
    tokens, kinds = int(totals.sum()), int(vocabulary.sum())

    fixed = rows.select("chunk", "number", "ids", "known", "log_counts").groupBy("chunk").cogroup(
        counted.filter("word_chunk IS NOT NULL").select("word_chunk", "shared").groupBy("word_chunk")).applyInArrow(
        lean_group(corrections), "chunk long, number int, log_counts double, n_known long")
    model, likelihoods = (None, []) if not tokens else train(rows.filter("NOT held_out"), totals, config)
    base = F.col("log_counts") - F.col("n_tokens") * math.log10(tokens + kinds + 1)
    head = rows.select("chunk", "number", "id", "held_out", "n_tokens", "classes")
    if model is None:
        scored = head.drop("classes").withColumn("path_score", F.lit(None).cast("double"))
    else:
        scored = head.mapInArrow(lean(score_rows(model, np.log10(totals + vocabulary + 1), config)),
                                 "chunk long, number int, id long, held_out boolean, n_tokens long, path_score double")
    frame = scored.join(fixed, ["chunk", "number"]).select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), F.coalesce(F.col("path_score") + F.col("log_counts"), base).alias("score"))
    return Scored(frame, model, likelihoods)
