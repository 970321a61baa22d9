"""Approximate nearest neighbours (largest inner product) by collision counting.

Directions (vectors over their norms) are indexed, norms kept beside them. Vectors are dealt into blocks of
bounded size, queries into blocks too, and each pair of blocks is one task. A block's index is one sorted array
of positions per projection line; lines are random orthonormal bases, as many as fill ``arrays`` lines. A query
opens a window around its own projection in every array, of one width for all; a vector collides in each array
whose window holds it. Its number of collisions tells its distance from the query's direction, with a known spread
(a coordinate of a random direction is at most ``x`` with probability ``I(x^2; 1/2, (dim - 1)/2)``).

First the vectors with the most promising collisions and norms are verified by the exact inner product; the k-th
verified score tells how near a vector must be to count, and the windows are widened to fit that distance
(virtual rehashing: the wider bucket is the next range of the same array). Then a vector is a candidate if its
collisions exceed a threshold: the number that a vector of its norm would need to reach the k-th verified score,
less ``certainty`` standard deviations. All candidates are verified. Nothing else stops the search: no share of the
block, no number of candidates. The best ``k`` of each block are merged.

Every vector is indexed and every query meets every block, so work is rows times queries: on directions without
clusters every vector is some distance from every query, and no cell could be left out. Collisions are counted on
16-bit ranks, a fraction of a multiplication by the vector.

Vectors that are NULL, empty,
zero or hold NULL or non-finite components take no part, nor do rows without an id.
Vectors of different length are not comparable: a query meets those of its own length.
Rows with the query's own id are not its neighbours; queries that repeat are one query.
Equal scores go by smaller id. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import lean_group


@dataclass
class Config:
    arrays: int = 160             # projection lines, 255 at most
    first: float = 1.0            # distance of directions that the first windows fit
    fit: float = 1.15             # half width of a window that fits a distance, in standard deviations of a coordinate
    certainty: float = 0.85       # standard deviations of collisions that a candidate may lack
    pilot: int = 4                # vectors verified first, in multiples of k
    block: int = 32_768           # vectors of a block, about
    query_block: int = 1_024      # queries of a block, about
    seed: int = 20


class Spread:
    """How collisions depend on distance: for ``lines`` lines in ``dim`` dimensions, by the half width over the
    distance."""

    def __init__(self, dim: int, lines: int, certainty: float):
        # |coordinate| of a random direction is sin(angle) with density cos(angle)^(dim - 2).
        angles = np.linspace(0, np.pi / 2, 20_001)[:-1]
        density = np.cos(angles) ** (max(dim, 2) - 2)
        mass = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
        ratios, chance = np.sin(angles), mass / mass[-1]
        variance = chance * (1 - chance)
        if dim >= 8:
            # Lines of a whole basis share the distance among them: collisions vary less than by chance.
            t = ratios * np.sqrt(dim)
            variance -= min(1, lines / dim) * 2 * (t * np.exp(-t * t / 2)) ** 2 / (2 * np.pi)
        counts = np.arange(lines + 1)
        least = np.maximum.accumulate(lines * chance - certainty * np.sqrt(lines * np.maximum(variance, 0)) - 0.5)
        # Per number of collisions: the largest and the likely ratio of half width to distance.
        self.largest = ratios[np.searchsorted(least, counts, "right") - 1]
        self.largest[-1] = np.inf
        self.likely = np.interp((counts + 0.5) / (lines + 1), chance, ratios)

    @staticmethod
    def cosines(width: float, ratios: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.maximum(1 - (width / ratios) ** 2 / 2, -1)


TOGETHER = 16    # queries whose first windows are opened together


def directions_of(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and norms; first brought to a largest component of 1, so squares neither vanish nor overflow."""
    largest = np.abs(vectors).max(axis=1)
    units = vectors / largest[:, None]
    norms = np.linalg.norm(units, axis=1)
    return units / norms[:, None], norms * largest


class Index:
    """Sorted arrays over one block of vectors."""

    def __init__(self, vectors: np.ndarray, config: Config):
        self.vectors, self.config = vectors, config
        n, dim = vectors.shape
        units, self.norms = directions_of(vectors)
        rng = np.random.default_rng(config.seed)
        bases = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-config.arrays // dim))]
        self.lines = np.concatenate(bases, axis=1)[:, :config.arrays]
        places = np.ascontiguousarray((units @ self.lines).T)
        order = np.argsort(places, axis=1, kind="stable")
        self.sorted = np.take_along_axis(places, order, axis=1)
        kind = np.uint16 if n < 1 << 16 else np.uint32
        self.ranks = np.empty(places.shape, kind)
        np.put_along_axis(self.ranks, order, np.broadcast_to(np.arange(n, dtype=kind), places.shape), axis=1)
        self.spread = Spread(dim, config.arrays, config.certainty)
        self.unit = config.fit / np.sqrt(dim)   # half width that fits a distance of 1
        self.verified = self.asked = 0          # vectors verified and queries asked, in all

    def collisions(self, centres: np.ndarray, width: float) -> np.ndarray:
        """Per query (a row of ``centres``): in how many arrays each vector lies within ``width`` of it."""
        n, kind = len(self.vectors), self.ranks.dtype.type
        counts = np.zeros((len(centres), n), np.uint8)
        offset, inside = np.empty(n, kind), np.empty(n, bool)
        as_numbers = inside.view(np.uint8)
        for ranks, row, own in zip(self.ranks, self.sorted, centres.T):
            # An array is gone through for all queries while it is at hand.
            low, high = row.searchsorted(own - width), row.searchsorted(own + width, "right")
            for count, a, b in zip(counts, low.tolist(), high.tolist()):
                if b > a:  # a <= rank < b, as one comparison of unsigned numbers
                    np.subtract(ranks, kind(a), out=offset)
                    np.less(offset, kind(b - a), out=inside)
                    np.add(count, as_numbers, out=count)
        return counts

    def candidates(self, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """For each query the positions that collide often enough to be among its ``k`` best."""
        config, n = self.config, len(self.vectors)
        directions, _ = directions_of(queries)
        centres = directions @ self.lines
        width = config.first * self.unit
        for number, query_id in enumerate(query_ids):
            if number % TOGETHER == 0:
                begun, together = width, self.collisions(centres[number:number + TOGETHER], width)
            width, counts = begun, together[number % TOGETHER]
            scores, able = np.full(n, -np.inf), ids != query_id

            def verify(found):
                scores[found] = self.vectors[found] @ directions[number]  # noqa: B023
                able[found] = False  # noqa: B023

            while True:
                likely = np.where(able, self.norms * self.spread.cosines(width, self.spread.likely)[counts], -np.inf)
                first = np.argpartition(-likely, config.pilot * k)[:config.pilot * k] if n > config.pilot * k else np.arange(n)
                verify(first[able[first]])
                best = np.argpartition(-scores, k)[:k] if n > k else np.arange(n)
                edge = scores[best].min()
                if edge == -np.inf:  # fewer than k vectors in all
                    break
                distance = np.sqrt(max(0.0, 2 - 2 * max(-1.0, edge / np.median(self.norms[best]))))
                if width >= 0.9 * distance * self.unit:
                    break
                width = distance * self.unit
                counts = self.collisions(centres[number:number + 1], width)[0]
            if edge > -np.inf:
                verify(np.flatnonzero(able & (self.norms * self.spread.cosines(width, self.spread.largest)[counts] >= edge)))
                # The next queries start where this one would have done best.
                width = max(distance, 1e-3) * self.unit
            found = np.flatnonzero(scores > -np.inf)
            self.verified, self.asked = self.verified + len(found), self.asked + 1
            yield found

    def search(self, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
        """(query number, vector numbers, scores) of each query's best candidates."""
        for number, found in enumerate(self.candidates(ids, query_ids, queries, k)):
            near = self.vectors[found]
            if len(found) > k:
                rough = near @ queries[number]
                edge = np.partition(rough, len(rough) - k)[len(rough) - k]
                first = rough >= edge - 1e-9 * max(1.0, abs(edge))
                found, near = found[first], near[first]
            # Summed row by row alike, so equal vectors score alike.
            scores = (near * queries[number]).sum(axis=1)
            best = np.lexsort((ids[found], -scores))[:k]
            yield number, found[best], scores[best]


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def matrix(table: pa.Table, name: str) -> np.ndarray:
    lists = table.column(name).combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            config: Config | None = None) -> DataFrame:
    """Per query its ``k`` best: query_id, rank (from 1), id, score."""
    config = config or Config()
    kept = F.col(vector_col).cast("array<double>")

    def of(frame: DataFrame) -> DataFrame:
        return (frame.select(F.col(id_col).cast("long").alias("id"), kept.alias("vector")).filter("id IS NOT NULL")
                .filter(usable(F.col("vector"))).withColumn("dim", F.size("vector")))

    base, asked = of(vectors), of(queries).distinct()
    # One row per vector length: how many blocks it is dealt into.
    blocks = base.groupBy("dim").agg(F.ceil(F.count("*") / config.block).cast("int").alias("blocks"))
    teams = asked.groupBy("dim").agg(F.ceil(F.count("*") / config.query_block).cast("int").alias("teams"))
    plan = F.broadcast(blocks.join(teams, "dim"))  # one row per vector length
    left = base.join(plan, "dim").select(
        "dim", F.pmod(F.xxhash64(F.lit("block"), "id", "vector"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("teams") - 1)).alias("team"), "id", "vector")
    right = asked.join(plan, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64(F.lit("team"), "id", "vector"), F.col("teams")).cast("int").alias("team"), "id", "vector")

    def search(key, base_rows, query_rows):
        out = ([], [], [], [])
        if base_rows.num_rows and query_rows.num_rows:
            query_rows = query_rows.sort_by("id")
            ids, query_ids = base_rows.column("id").to_numpy(), query_rows.column("id").to_numpy()
            queries_ = matrix(query_rows, "vector")
            for number, found, scores in Index(matrix(base_rows, "vector"), config).search(ids, query_ids, queries_, k):
                out[0].append(np.full(len(found), number))
                out[1].append(ids[found])
                out[2].append(scores)
        if not out[0]:
            return pa.table({"query_id": pa.array([], pa.int64()), "query_hash": pa.array([], pa.int64()),
                             "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        number = np.concatenate(out[0])
        # Tells apart queries that share an id but not a vector.
        hashes = np.array([xxhash.xxh64_intdigest(row.tobytes()) for row in queries_], np.uint64).view(np.int64)
        return pa.table({"query_id": query_ids[number], "query_hash": hashes[number],
                         "id": np.concatenate(out[1]), "score": np.concatenate(out[2])})

    keys = ["dim", "block", "team"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lean_group(search), "query_id long, query_hash long, id long, score double")
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "id")
    return (met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
