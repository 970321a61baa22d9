"""Toxicity scores by weak supervision.

1. Lexicons are mined from a bounded sample of labelled rows (words and word
   prefixes that toxic documents hold far more often), beside small fixed lexicons
   and text patterns. Groups of them are *voters*: each fires on a document or not.
2. A generative label model is fitted by EM on the counts of vote patterns over all
   documents (at most 2^voters patterns, whatever the corpus). It estimates each
   voter's firing rates in both classes; voters that stay correlated given the class
   are joined into cliques with one joint table each, and the model is fitted again.
3. A linear (logistic) classifier is trained on posterior labels of a bounded sample
   of learning rows, over the mined words and prefixes and the votes, and scores all.

Only the text is an input of a score. NULL text counts as empty; empty texts, like
texts without any known feature, get the classifier's bias. Repeated rows score alike;
labels that repeat for a document are averaged, NULL labels and ids are ignored. With no
labels of one of the classes nothing is mined: only the fixed lexicons and patterns
vote. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Memo, bound_batches, id_fold, kept, lean, release, text_slices

# Seed lexicons of the built-in voters.
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
           "imbecile", "vermin", "filth", "dumbass", "bastard", "bitch", "asshole", "idiota", "estúpido", "basura",
           "imbécil", "dummkopf", "abschaum", "arschloch", "connard", "salaud", "ordure", "crétin"]
THREATS = ["kill", "murder", "strangle", "exterminate", "lynch", "matar", "töten", "tuer"]
PREFIXES = (4, 5, 6)
EDGE = ".,;:!?\"'()[]{}<>«»¿¡-_*"

MINED_VOTERS = [(kind, half) for kind in ("w", "p4", "p5", "p6") for half in (0, 1)]
VOTERS = [f"mined_{kind}_{half}" for kind, half in MINED_VOTERS] + ["insults", "threats", "insult_at_you", "shouting"]
AT_YOU = re.compile(rb"\b(?:you|du|tu|vous|eres)\b[^.!?\n]{0,40}\b(?:" +
                    "|".join(INSULTS).encode() + rb")\b", re.I)
SHOUT = re.compile(rb"(?:\b[A-Z]{4,}\b[ ,!]+){3}|!{3}")


@dataclass
class Config:
    max_labelled: int = 30_000    # labelled rows the lexicons are mined from, at most
    max_train: int = 20_000       # rows the linear classifier is trained on, at most, labelled and not each
    max_features: int = 3_000     # mined features per sign
    min_docs: int = 3             # texts of its class a mined feature occurs in
    vote_odds: float = 12.0       # a feature votes if its odds ratio is surely above this
    correlation: float = 0.2      # given the class, above this two voters share a table
    max_clique: int = 4
    folds: int = 5
    rounds: int = 60


@dataclass
class LabelModel:
    prior: float
    cliques: list[list[int]]
    tables: list[np.ndarray]                  # per clique: (2, 2^size) firing probabilities
    accuracies: dict[str, tuple[float, float]] = field(default_factory=dict)   # firing rates: clean, toxic
    correlations: dict[tuple[str, str], float] = field(default_factory=dict)   # given the class, of joined voters

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        odds = np.full(len(patterns), math.log(self.prior) - math.log1p(-self.prior))
        for members, table in zip(self.cliques, self.tables):
            cell = clique_cells(patterns, members)
            odds += np.log(table[1][cell]) - np.log(table[0][cell])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def clique_cells(patterns: np.ndarray, members: list[int]) -> np.ndarray:
    cell = np.zeros(len(patterns), np.int64)
    for place, voter in enumerate(members):
        cell |= ((patterns >> voter) & 1) << place
    return cell


def word_features(word: bytes) -> list[str]:
    """The word and its prefixes, as features; punctuation at its edges is no part of it."""
    clean = word.decode("utf-8", "replace").strip(EDGE).lower()
    if not clean:
        return []
    return [f"w:{clean}", *(f"p{n}:{clean[:n]}" for n in PREFIXES if len(clean) > n)]


def mine_counts(batches):
    """Documents of either class per feature, summed within the task in bounded tables."""
    memo, counts = Memo(word_features), ({}, {})
    schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def flush():
        bad, good = counts
        names = list(bad.keys() | good.keys())
        out = pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([bad.get(x, 0) for x in names], pa.int64()),
                                          pa.array([good.get(x, 0) for x in names], pa.int64())], schema=schema)
        bad.clear()
        good.clear()
        return out

    for batch in batches:
        labels = batch.column(batch.schema.get_field_index("toxic")).to_pylist()
        for start, texts in text_slices(batch):
            for toxic, text in zip(labels[start:], texts):
                found = set()
                for word in set(text.split()):
                    found.update(memo[word])
                memo.trim()
                table = counts[0] if toxic else counts[1]
                for x in found:
                    table[x] = table.get(x, 0) + 1
                if len(counts[0]) + len(counts[1]) > 200_000:
                    yield flush()
    yield flush()


def mined_features(sample: DataFrame, config: Config) -> dict[str, tuple[float, bool]]:
    """feature -> (signed log-likelihood ratio, whether it votes): the strongest of either sign, ``max_features`` each at most."""
    # A text counts once, however many copies of it are labelled.
    sample = sample.groupBy("toxic", F.xxhash64("text")).agg(F.first("text").alias("text")).select("toxic", "text")
    sample = kept(sample)
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}
    counts = (sample.mapInArrow(lean(mine_counts), "feature string, toxic long, clean long")
              .groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    log_odds, error = F.log(a / (bad + 1)) - F.log(b / (good + 1)), F.sqrt(1 / a + 1 / b)
    due = (F.col("a") + F.col("b")) / (bad + good)
    part = lambda n, size: F.when(n > 0, n * F.log(n / (due * size))).otherwise(0.0)
    gain = 2 * (part(F.col("a"), bad) + part(F.col("b"), good)) * F.signum(log_odds)
    scored = kept(counts.filter((F.col("a") >= config.min_docs) | (F.col("b") >= config.min_docs))
                   .select("feature", "a", "b", F.round(gain, 6).alias("gain"),
                           (log_odds - error > math.log(config.vote_odds)).alias("sure")))
    # Beyond what the best of as many unrelated features would reach by chance.
    least = 2 * math.log(scored.count() + 1)
    out: dict[str, tuple[float, bool]] = {}
    for sign, enough in ((1, F.col("a") >= config.min_docs), (-1, F.col("b") >= config.min_docs)):
        best = (scored.filter(enough & (F.col("gain") * sign >= least)).orderBy(F.desc(F.col("gain") * sign), "feature")
                .limit(config.max_features))
        out |= {r["feature"]: (r["gain"], r["sure"]) for r in best.collect()}
    release(scored)
    release(sample)
    return out


def feature_tables(mined: dict[str, tuple[float, bool]]) -> tuple[dict[str, int], np.ndarray]:
    """feature -> position, and the voter of each position (-1: none). Only sure signs of toxicity vote."""
    names = sorted(mined)
    index = {name: i for i, name in enumerate(names)}
    voter = np.full(len(names), -1, np.int64)
    places = {key: i for i, key in enumerate(MINED_VOTERS)}
    turn: Counter = Counter()
    for name in sorted(names, key=lambda x: (-mined[x][0], x)):
        if mined[name][1]:
            kind = name.partition(":")[0]
            voter[index[name]] = places[(kind, turn[kind] % 2)]
            turn[kind] += 1
    return index, voter


def vote_rows(index: dict[str, int], voter: np.ndarray, insults: list[str], threats: list[str]):
    """Arrow function: whole texts to vote patterns and present features."""
    base = len(MINED_VOTERS)
    fixed = {w: 1 << base for w in insults} | {w: 1 << (base + 1) for w in threats}

    nothing = ((), 0)

    def known(word: bytes) -> tuple:
        clean = word.decode("utf-8", "replace").strip(EDGE).lower()
        ids = tuple(index[x] for x in word_features(word) if x in index)
        bits = fixed.get(clean, 0)
        if not ids and not bits:
            return nothing
        for i in ids:
            if voter[i] >= 0:
                bits |= 1 << int(voter[i])
        return ids, bits

    def run(batches):
        memo = Memo(known)
        for batch in batches:
            patterns, features = [], []
            for _, texts in text_slices(batch):
                for text in texts:
                    bits, present = 0, set()
                    for word in set(text.split()):
                        ids, fired = memo[word]
                        if ids:
                            present.update(ids)
                        bits |= fired
                    memo.trim()
                    if bits & (1 << base) and AT_YOU.search(text):
                        bits |= 1 << (base + 2)
                    if SHOUT.search(text):
                        bits |= 1 << (base + 3)
                    patterns.append(bits)
                    features.append(sorted(present))
            keep = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(patterns, pa.int64()), pa.array(features, pa.list_(pa.int32()))],
                                             names=[*names, "pattern", "features"])
    return run


def fit_label_model(patterns: np.ndarray, free: np.ndarray, clean: np.ndarray, toxic: np.ndarray,
                    config: Config) -> LabelModel:
    """EM over pattern counts; ``clean`` and ``toxic`` are counts of labelled learning rows."""
    voters = len(VOTERS)

    def fit(cliques: list[list[int]], weight: np.ndarray | None) -> tuple[LabelModel, np.ndarray]:
        if weight is None:  # start: a document is likelier toxic the more voters fire
            fired = sum(((patterns >> v) & 1) for v in range(voters - 1))
            weight = np.where(fired > 0, 1 - 0.5 ** (1 + fired), 0.02)
        for _ in range(config.rounds):
            bad, good = free * weight + toxic, free * (1 - weight) + clean
            prior = float(np.clip((bad.sum() + 1) / (bad.sum() + good.sum() + 2), 1e-6, 0.5))
            tables = []
            for members in cliques:
                cell, size = clique_cells(patterns, members), 1 << len(members)
                table = np.stack([np.bincount(cell, x, size).astype(float) for x in (good, bad)])
                # A weak prior of what a voter is: seldom fires on clean text, often on toxic text.
                quiet = np.array([bin(c).count("1") for c in range(size)])
                table[0] += 2 * 0.02 ** quiet * 0.98 ** (len(members) - quiet)
                table[1] += 2 * 0.5 ** len(members)
                tables.append(table / table.sum(1, keepdims=True))
            model = LabelModel(prior, cliques, tables)
            new = model.posterior(patterns)
            change, weight = float(np.abs(new - weight).max(initial=0)), new
            if change < 1e-6:
                break
        return model, weight

    fires = np.stack([((patterns >> v) & 1).astype(float) for v in range(voters)])

    def residual(weight: np.ndarray) -> np.ndarray:
        """Correlation of each two voters given the class, in the class where it is stronger."""
        strongest = np.zeros((voters, voters))
        for mass in (free * weight + toxic, free * (1 - weight) + clean):
            if mass.sum() <= 0:
                continue
            centred = fires - (fires @ mass / mass.sum())[:, None]
            cov = (centred * mass) @ centred.T / mass.sum()
            dev = np.sqrt(np.diag(cov))
            seen = np.outer(dev, dev) * np.outer(dev > 1e-3, dev > 1e-3)
            r = np.divide(cov, seen, out=np.zeros_like(cov), where=seen > 0)
            strongest = np.where(np.abs(r) > np.abs(strongest), r, strongest)
        return np.triu(strongest, 1)

    # The strongest dependence left is joined, then the model is fitted anew: what looked
    # like a dependence of others under the wrong model goes with it.
    cliques, correlations = [[v] for v in range(voters)], {}
    model, weight = fit(cliques, None)
    while True:
        left = residual(weight)
        of = {v: c for c in cliques for v in c}
        pairs = [(abs(left[i, j]), i, j) for i in range(voters) for j in range(i + 1, voters)
                 if of[i] is not of[j] and len(of[i]) + len(of[j]) <= config.max_clique]
        best = max(pairs, default=(0.0, 0, 0))
        if best[0] <= config.correlation:
            break
        _, i, j = best
        correlations[VOTERS[i], VOTERS[j]] = float(left[i, j])
        cliques = [c for c in cliques if c is not of[i] and c is not of[j]] + [sorted(of[i] + of[j])]
        model, weight = fit(cliques, weight)
    model.correlations = correlations
    for members, table in zip(model.cliques, model.tables):
        for place, v in enumerate(members):
            fired = (np.arange(table.shape[1]) >> place & 1).astype(bool)
            model.accuracies[VOTERS[v]] = (float(table[0][fired].sum()), float(table[1][fired].sum()))
    return model


def fit_linear(rows: list[list[int]], target: np.ndarray, size: int, steps: int = 300, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels over sparse 0/1 features; the last weight is the bias."""
    weights, mean, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    if not len(rows):
        weights[-1] = -4.0
        return weights
    lengths = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    ids = np.fromiter((i for r in rows for i in r), np.int64, int(lengths.sum()))
    for step in range(1, steps + 1):
        margin = np.bincount(owner, weights[ids], len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target) / len(rows)
        grad = np.append(np.bincount(ids, error[owner], size), error.sum())
        grad[:-1] += ridge * weights[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        weights -= 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-10)
    return weights


@dataclass
class Scored:
    frame: DataFrame          # id, held_out, score, predicted, posterior, text_hash
    model: LabelModel
    weights: np.ndarray
    mined: dict[str, tuple[float, bool]]


def toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", config: Config | None = None) -> Scored:
    """Score every document. See the module docstring for the method and the edge cases."""
    config = config or Config()
    bound_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("id", F.xxhash64("text").alias("text_hash"), "text")
    learn = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).dropna()
             .filter(id_fold("id", config.folds) > 0)
             .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("toxic")))
    order = F.xxhash64(F.lit("label sample"), "id")
    sample = learn.orderBy(order, "id").limit(config.max_labelled)
    # At most ``max_labelled`` narrow rows, so this side has a fixed size bound.
    mined = mined_features(docs.join(F.broadcast(sample), "id").select("toxic", "text"), config)
    index, voter = feature_tables(mined)

    votes = kept(docs.mapInArrow(lean(vote_rows(index, voter, INSULTS, THREATS)),
                                  f"id {docs.schema['id'].dataType.simpleString()}, text_hash long, pattern long, features array<int>"))
    marked = votes.join(learn, "id", "left")
    counts = (marked.groupBy("pattern").agg(F.sum(F.when(F.col("toxic").isNull(), 1).otherwise(0)).alias("free"),
                                            F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0)).alias("clean"),
                                            F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"))
              .orderBy("pattern").collect())  # at most 2^voters rows
    patterns = np.array([r["pattern"] for r in counts], np.int64)
    model = fit_label_model(patterns, *(np.array([r[c] for r in counts], float) for c in ("free", "clean", "bad")), config)

    size = len(index)
    learning = marked.filter(id_fold("id", config.folds) > 0)
    rows, target = [], []
    for known in (True, False):
        part = learning.filter(F.col("toxic").isNotNull() if known else F.col("toxic").isNull())
        # No feature lists cross the driver's bound: at most max_train rows of at most 2 * max_features ids.
        for r in (part.orderBy(F.xxhash64(F.lit("train sample"), "id"), "id").limit(config.max_train)
                  .select("pattern", "features", "toxic").toLocalIterator()):
            rows.append([*r["features"], *(size + v for v in range(len(VOTERS)) if r["pattern"] >> v & 1)])
            target.append((r["pattern"], r["toxic"]))
    soft = model.posterior(np.array([p for p, _ in target], np.int64)) if target else np.zeros(0)
    soft = np.array([0.01 + 0.98 * y if y is not None else s for s, (_, y) in zip(soft, target)])
    weights = fit_linear(rows, soft, size + len(VOTERS))

    table = [float(x) for x in weights]
    posterior = dict(zip(patterns.tolist(), model.posterior(patterns).tolist()))

    def score(batches):
        linear = np.array(table)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("features"))
            bits = np.asarray(batch.column(batch.schema.get_field_index("pattern")))
            offsets, ids = np.asarray(lists.offsets), np.asarray(lists.values)
            owner = np.repeat(np.arange(len(bits)), np.diff(offsets))
            margin = np.bincount(owner, linear[ids[offsets[0]:offsets[-1]]], len(bits)) + linear[-1]
            for v in range(len(VOTERS)):
                margin += ((bits >> v) & 1) * linear[size + v]
            got = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("id")), batch.column(batch.schema.get_field_index("text_hash")),
                 pa.array(got), pa.array([posterior.get(int(p), 0.5) for p in bits], pa.float64())],
                names=["id", "text_hash", "score", "posterior"])

    kind = docs.schema["id"].dataType.simpleString()
    scored = votes.mapInArrow(lean(score), f"id {kind}, text_hash long, score double, posterior double")
    frame = scored.select(F.col("id").alias(id_col), (id_fold("id", config.folds) == 0).alias("held_out"), "score",
                          (F.col("score") >= 0.5).cast("int").alias("predicted"), "posterior", "text_hash")
    return Scored(frame, model, weights, mined)
