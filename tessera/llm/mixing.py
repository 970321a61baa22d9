"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (NULL last) weigh 3, 1, 2, repeating, and share
``share`` of all words; a source's target stops at ``most`` times its words and the excess
goes to the others by weight until none is above.

Rates: of all document rates r in (0, most], the ones closest in entropy to taking every
document once, subject to each source's token constraint sum(r * size) = target, are
r = min(most, exp(lambda_source * size / mean size)). The convex dual in lambda is solved
by Newton steps, kept inside a bracket. A step needs two sums per source, taken by Spark
over the (source, size) histogram, which is exact and far smaller than the documents. A
source at its ceiling takes all its documents ``most`` times.

Rounding: a source's (size, documents) cells are taken from the longest documents down;
each gets the whole number of copies nearest to its tilted words plus what is still owed,
so the error shrinks with the sizes and a source ends within about its shortest documents
of its target. A source has at most as many cells as its longest text has words. Inside a
cell documents are ranked by a hash of their id; large cells are ranked in hashed parts of
bounded size. All sums that rates depend on are decimal, so reruns agree whatever the order
of tasks.

NULL and empty texts have size 0: they take no words, and get their rate of copies all the
same. NULL is a source of its own. Repeated rows are rows like others. Empty tables give
empty results; extra columns are ignored. The list of sources (not of documents) is
configuration and is held by the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, kept, lean, text_slices, whole_rows

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2
CELL_PART = 256         # documents ranked together, about
MAX_STEPS = 200


def targets(sizes: dict[str | None, int], weights=WEIGHTS, share=SHARE, most: int = MOST) -> dict[str | None, Fraction]:
    """Exact targets per source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, open_ = Fraction(share) * sum(sizes.values()), set(order)
    out = {s: Fraction(0) for s in order}
    while open_ and (total := sum(weight[s] for s in open_)):
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            out.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


@dataclass
class Dual:
    """One source's multiplier and the bracket it is known to lie in."""
    target: float
    words: int
    mean: float
    value: float = 0.0
    low: float = -math.inf
    high: float = math.inf
    done: bool = False

    def update(self, got: float, slope: float) -> None:
        if abs(got - self.target) <= max(1e-3, 1e-9 * self.target):
            self.done = True
            return
        if got < self.target:
            self.low = self.value
        else:
            self.high = self.value
        step = self.value + (self.target - got) / slope if slope > 0 else math.nan
        if math.isnan(step) or not self.low < step < self.high:
            if math.isinf(self.high):
                step = max(1.0, 2 * self.low) if self.low > 0 else self.low + 1.0
            elif math.isinf(self.low):
                step = min(-1.0, 2 * self.high) if self.high < 0 else self.high - 1.0
            else:
                step = (self.low + self.high) / 2
        if step == self.value or self.high - self.low < 1e-13 * max(1.0, abs(self.low)):
            self.done = True
            return
        self.value = step


def source_key(column):
    """Source as a join key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), column), F.lit("null"))


def key_of(source: str | None) -> str:
    return "null" if source is None else f"={source}"


def balance(cells: DataFrame, duals: dict[str, Dual], most: int = MOST) -> None:
    """Newton iterations over all sources at once; ``cells`` has key, size, n."""
    spark = cells.sparkSession
    for _ in range(MAX_STEPS):
        at = [(k, d.value, d.mean) for k, d in duals.items() if not d.done]
        if not at:
            return
        now = spark.createDataFrame(at, "key string, dual double, mean double")
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("dual") * z, F.lit(700.0))))
        words = F.col("n") * F.col("size") * rate
        sums = (cells.join(now, "key").groupBy("key")
                .agg(F.sum(words.cast("decimal(38,9)")).cast("double").alias("got"),
                     F.sum(F.when(rate < most, words * z).otherwise(0.0).cast("decimal(38,9)")).cast("double").alias("slope")))
        for r in sums.collect():  # one row per open source
            duals[r["key"]].update(r["got"], r["slope"])
    raise RuntimeError("entropy balancing did not converge")


def size_rows(batches):
    """Arrow function: the text, last, replaced by its number of words."""
    for batch in batches:
        sizes = [len(text.split()) for _, texts in text_slices(batch) for text in texts]
        kept_columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept_columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names[:-1], "size"])


def whole_copies(most: int):
    """Arrow function over one source's cells: copies per cell, what is owed carried to shorter documents."""
    def run(table):
        table = table.sort_by([("size", "descending")])
        owed, out = 0.0, []
        for size, n, rate in zip(*(table.column(c).to_pylist() for c in ("size", "n", "rate"))):
            due = n * rate * size + owed
            copies = min(most * n, max(0, math.floor(due / size + 0.5))) if size else math.floor(n * min(rate, 1.0) + 0.5)
            owed = due - copies * size if size else owed
            out.append(copies)
        return table.append_column("copies_all", pa.array(out, pa.int64()))
    return run


def mix(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """Per document: id, source, size, source_size, target, rate, copies, taken, text_hash."""
    bound_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                            F.col(text_col).cast("string").alias("text"))
    docs = docs.select("id", "source", source_key(F.col("source")).alias("key"), F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["id"].dataType.simpleString()
    docs = kept(docs.mapInArrow(lean(size_rows), f"id {kind}, source string, key string, text_hash long, size long"))
    cells = kept(docs.groupBy("key", "source", "size").agg(F.count("*").alias("n")))
    sources = cells.groupBy("key", "source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("words"),
                                                 F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("n")).collect()
    wanted = targets({r["source"]: r["words"] for r in sources}, weights, share, most)
    duals = {}
    for r in sources:
        target, words = wanted[r["source"]], r["words"]
        if 0 < target < most * words:
            duals[r["key"]] = Dual(float(target), words, words / r["n"])
    balance(cells, duals, most)

    rows = []
    for r in sources:
        target, dual = wanted[r["source"]], duals.get(r["key"])
        # Without a dual: at the ceiling, or nothing to take.
        fixed = None if dual else (float(most) if target > 0 else 1.0 if not r["words"] else 0.0)
        rows.append((r["key"], r["words"], float(target), dual.value if dual else 0.0, dual.mean if dual else 1.0, fixed))
    plan = documents.sparkSession.createDataFrame(
        rows, "key string, source_size long, target double, dual double, mean double, fixed double")
    tilt = F.least(F.lit(float(most)), F.exp(F.least(F.col("dual") * F.col("size") / F.col("mean"), F.lit(700.0))))
    tilted = cells.drop("source").join(plan, "key").withColumn("rate", F.coalesce("fixed", tilt))
    fields = "key string, size long, n long, source_size long, target double, rate double"
    allotted = kept(tilted.select("key", "size", "n", "source_size", "target", "rate").groupBy("key")
                     .applyInArrow(whole_copies(most), f"{fields}, copies_all long"))

    parts = F.ceil(F.col("n") / CELL_PART)
    met = (docs.join(allotted, ["key", "size"])
           .withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "id", "text_hash"), parts))
           # Dealt anew by part too: a cell of copies is never one task.
           .repartition("key", "size", "part"))
    cell = Window.partitionBy("key", "size", "part")
    rank = F.row_number().over(cell.orderBy(F.xxhash64(F.lit("rank"), "id", "text_hash"), "id", "text_hash"))
    base = F.floor(F.col("copies_all") / F.col("n"))
    extra = F.col("copies_all") - base * F.col("n")
    dither = F.pmod(F.xxhash64(F.lit("dither"), "key", "size", "part"), F.lit(1 << 20)) / float(1 << 20)
    chosen = rank <= F.floor(F.count("*").over(cell) * extra / F.col("n") + F.when(parts > 1, dither).otherwise(1e-9))
    return met.withColumn("copies", (base + chosen.cast("long")).cast("long")).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate",
        "copies", (F.col("copies") * F.col("size")).alias("taken"), "text_hash")


def mixed_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The documents, all columns (of whatever names), each row as often as the mix takes it."""
    plan = mix(documents, id_col, text_col, source_col, **options)
    # Rows that agree in id and text share their copies evenly.
    shares = plan.groupBy(F.col(id_col).alias("mix_id"), F.col("text_hash").alias("mix_hash"),
                          F.col(source_col).alias("mix_source")).agg(F.sum("copies").alias("mix_copies"),
                                                                     F.count("*").alias("mix_rows"))
    keyed = documents.select(whole_rows(documents).alias("row"), F.col(id_col).alias("own_id"),
                             F.xxhash64(F.col(text_col).cast("string")).alias("own_hash"),
                             F.col(source_col).cast("string").alias("own_source"))
    same = (F.col("own_id").eqNullSafe(F.col("mix_id")) & (F.col("own_hash") == F.col("mix_hash")) &
            F.col("own_source").eqNullSafe(F.col("mix_source")))
    met = keyed.join(shares, same)
    number = F.row_number().over(Window.partitionBy("mix_id", "own_hash", "mix_source").orderBy("mix_rows"))
    upto = lambda k: F.floor(F.col("mix_copies") * k / F.col("mix_rows"))
    own = F.when(F.col("mix_rows") == 1, F.col("mix_copies")).otherwise(upto(number) - upto(number - 1)).cast("int")
    return (met.withColumn("own", own).filter("own > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("copy")).select("row.*"))
