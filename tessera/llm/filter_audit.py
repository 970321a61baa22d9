"""Filter interaction audit by min-plus removal ranks.

Filters judge documents apart from each other, so all that an order of filters does to a document follows from
the mask of the filters it fails. With masks as a matrix ``M`` (0 where the filter fails, infinite where not) and
the orders' inverse permutations as a matrix ``P`` (the step at which an order applies a filter), the min-plus
product ``R = M (min,+) P`` is the step at which an order removes the documents of a mask. ``R`` drives the rest:
weights of masks (documents, good ones, toxic ones) are scattered onto (order, step) for what is removed, and
failing masks with an earlier ``R`` are the redundant ones.

Documents reach this as counts. One pass over the texts gives narrow rows (id, 128-bit text digest, lang, bits
of the text filters); no text is shuffled. Labels join by id. Copies are told by digest: counts and least id per
(digest, lang, labels), pre-aggregated so that a text with a third of all rows is a few rows, then the least id
over a digest's few rows. What is left is a table of at most 128 counts a lang, one small group each.

The five filters fail documents with under 200 words (A), under half of their words distinct (B), over 3 %
upper-case A-Z of all code points (C), any of ``#$%&*|`` (D), and the text of a smaller id (E, table-wide, also
of documents that other filters remove).

NULL or empty texts have no words: they fail A, and E where a smaller id is empty too. NULL langs are the empty
string. Rows that repeat an id and text are documents of their own, none a copy of the other; NULL ids come after
all others and have no label; of repeated labels one set mark is enough. Empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, lean, lean_group, text_slices

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 200, 50, 3
MARKS = b"#$%&*|"
UPPER = bytes(range(0x41, 0x5B))
TAILS = bytes(range(0x80, 0xC0))     # bytes that continue a code point
COPY = 1 << FILTERS.index("E")

ROW = "doc_id long, digest binary, lang string, fails int"
REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def failed_filters(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    n = len(words)
    points = len(text.translate(None, TAILS))
    upper = len(text) - len(text.translate(None, UPPER))
    return ((n < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
            | (100 * upper > UPPER_PERCENT * points) << 2 | (len(text.translate(None, MARKS)) != len(text)) << 3)


def judged(batches):
    for batch in batches:
        digests, fails = [], []
        for _, texts in text_slices(batch):
            digests += [hashlib.blake2b(t, digest_size=16).digest() for t in texts]
            fails += [failed_filters(t) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), batch.column(1), pa.array(fails, pa.int32())],
                                         ["doc_id", "digest", "lang", "fails"])


def removal_ranks(n_filters: int = len(FILTERS)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(orders, their inverse permutations P, R): filters by step, steps by filter, and per mask and order the
    removing step; n_filters + 1 where nothing removes. Steps count from 1."""
    orders = np.array(list(itertools.permutations(range(n_filters))))
    places = np.argsort(orders, axis=1) + 1
    failing = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    never = n_filters + 1
    costs = np.where(failing, 0, never)
    return orders, places, np.minimum((costs[:, None, :] + places[None, :, :]).min(axis=2), never)


def scatter(weights: np.ndarray, ranks: np.ndarray, steps: int) -> np.ndarray:
    """Weights of masks added up at (order, removing step), exactly."""
    n_orders = ranks.shape[1]
    out = np.zeros((n_orders, steps + 2), np.int64)
    np.add.at(out, (np.broadcast_to(np.arange(n_orders), ranks.shape), ranks), np.broadcast_to(weights[:, None], ranks.shape))
    return out[:, 1:steps + 1]


def audit(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Report columns as (order, step) matrices from counts by (mask, good, toxic)."""
    n = len(FILTERS)
    orders, places, ranks = removal_ranks(n)
    weights = counts.sum(axis=(1, 2))
    removed = scatter(weights, ranks, n)
    failing = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1 > 0
    redundant = np.empty_like(removed)
    for step in range(n):
        earlier = failing[:, orders[:, step]] & (ranks <= step)     # masks by orders: fails this step's filter, gone before it
        redundant[:, step] = (weights[:, None] * earlier).sum(axis=0)
    alone = weights[1 << np.arange(n)]
    shapley = np.array([removed[np.arange(len(orders)), places[:, f] - 1].sum() for f in range(n)])
    return {"kept": weights.sum() - removed.cumsum(axis=1), "removed": removed, "redundant": redundant, "unique_fails": alone[orders],
            "good_lost": scatter(counts[:, 1, :].sum(axis=1), ranks, n), "toxic_lost": scatter(counts[:, :, 1].sum(axis=1), ranks, n),
            "shapley": shapley[orders]}


def report(table: pa.Table) -> pa.Table:
    """The rows of one part: every order and step."""
    n = len(FILTERS)
    counts = np.zeros((1 << n, 2, 2), np.int64)
    at = [table.column(c).to_numpy().astype(int) for c in ("fails", "good", "toxic")]
    np.add.at(counts, tuple(at), table.column("rows").to_numpy())
    columns = audit(counts)
    orders = ["".join(FILTERS[f] for f in order) for order in removal_ranks(n)[0]]
    names = {"part": np.repeat(table.column("part")[0].as_py(), len(orders) * n).astype(object),
             "filter_order": np.repeat(np.array(orders, object), n), "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))}
    return pa.table(names | {k: v.ravel().astype(np.int64) for k, v in columns.items()})


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, rows): documents by all five filters, lang and labels."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.col("text").cast("string").alias("text")).mapInArrow(lean(judged), ROW)
    marks = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    marked = (rows.join(marks, "doc_id", "left")
              .groupBy("doc_id", "digest", "lang", "fails", F.coalesce("good", F.lit(False)).alias("good"),
                       F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(F.count(F.lit(1)).alias("n")))
    own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "n")
    groups = marked.groupBy("digest", "lang", "fails", "good", "toxic").agg(F.sum("n").alias("rows"), F.min(own).alias("least"))
    first = F.min(F.struct("least.nameless", "least.doc_id")).over(Window.partitionBy("digest"))
    originals = F.when(F.struct("least.nameless", "least.doc_id").eqNullSafe(F.col("first")), F.col("least.n")).otherwise(F.lit(0))
    split = F.array(F.struct(F.col("fails").alias("fails"), originals.alias("rows")),
                    F.struct(F.col("fails").bitwiseOR(F.lit(COPY)).alias("fails"), (F.col("rows") - originals).alias("rows")))
    return (groups.withColumn("first", first).select(F.col("lang").alias("part"), "good", "toxic", F.inline(split))
            .filter("rows > 0").groupBy("part", "fails", "good", "toxic").agg(F.sum("rows").alias("rows")))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (lang), order of the five filters and step: what is kept, removed, redundant, lost (see REPORT)."""
    return mask_counts(docs, labels).groupBy("part").applyInArrow(lean_group(report), REPORT)
