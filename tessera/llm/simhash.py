"""SimHash near-duplicates: fingerprints, links by a binary-trie self-join, components.

Fingerprint: A-Z lower-cased, words joined by one space, 3-word shingles with repeats
(fewer words: the whole sequence); XXH64 (seed 42) of each; a bit is 1 if it is set in
more than half of the hashes. No words (NULL and empty texts too): fingerprint zero,
linked like any other.

Links: fingerprints that differ in at most ``max_bits`` bits. Equal fingerprints are one
node, so a group of exact copies of any size enters the join once. The binary trie over
the distinct fingerprints is cut into subtries of bounded size (deeper where it is
denser); a walk over pairs of cut nodes adds up differing bits and drops pairs beyond
the budget, so each remaining pair of subtries is a task of its own. Within the task the
same walk goes on, level by level, over sorted arrays. A task reports a spanning forest
of the links it found, not all pairs: no link between components is lost, and its output
is at most its input.

Components: alternating large-star and small-star rounds over the forests, each round
written to the shared folder.

Result per input row: id, fingerprint, component_id (smallest id reachable, NULL ids
aside; NULL if the component has no id), component_node (one fingerprint per component,
never NULL), text_hash. Repeated rows and ids keep their rows. Empty tables give empty results;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bound_batches, kept, lean, lean_group, release, saved, text_slices

SEED = 42
CUT_BITS = 16             # depth of the histogram the trie is cut by: 65,536 counters at most
MAX_SUBTRIE = 262_144     # fingerprints of a cut node, at most, down to the histogram's depth
MIN_PARTS = 16            # a trie is cut into at least about this many parts
FRONTIER = 1 << 15        # node pairs walked at once in a task


def fingerprint_of(text: bytes, size: int = 3) -> int:
    """The 64-bit fingerprint of a text. ``bytes.lower`` folds A-Z and nothing else."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(flat, SEED)]
    else:
        digest, ends = xxhash.xxh64_intdigest, np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-size].tolist()]
        hashes = [digest(flat[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:].tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes; long lists are counted in blocks."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.ascontiguousarray(hashes[at:at + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprint_rows(size: int):
    def run(batches):
        for batch in batches:
            prints = [fingerprint_of(text, size) for _, texts in text_slices(batch) for text in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                              pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())],
                                             names=["id", "text_hash", "node"])
    return run


def cut_trie(counts: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(depth, prefix) of the cut nodes: the first on each path with at most ``most`` below, or the deepest."""
    out, level = [], [(0, 0, 0, len(counts))]
    while level:
        depth, prefix, low, high = level.pop()
        n = counts[low:high].sum()
        if not n:
            continue
        if n <= most or high - low == 1:
            out.append((depth, prefix))
            continue
        middle = (low + high) // 2
        level += [(depth + 1, prefix << 1, low, middle), (depth + 1, (prefix << 1) | 1, middle, high)]
    return sorted(out, key=lambda x: x[1] << (64 - x[0]))


def cut_pairs(nodes: list[tuple[int, int]], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i <= j) of cut nodes whose prefixes differ in at most ``max_bits`` of their common bits."""
    depth = np.array([d for d, _ in nodes], np.int64)
    prefix = np.array([p for _, p in nodes], np.int64)
    first, second = [], []
    for i in range(len(nodes)):
        common = np.minimum(depth[i], depth[i:])
        differing = (prefix[i] >> (depth[i] - common)) ^ (prefix[i:] >> (depth[i:] - common))
        close = np.flatnonzero(np.bitwise_count(differing) <= max_bits) + i
        first.append(np.full(len(close), i))
        second.append(close)
    return np.concatenate(first or [np.zeros(0, int)]), np.concatenate(second or [np.zeros(0, int)])


class Forest:
    """Union of positions by pointer jumping over whole arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up


def trie_links(left: np.ndarray, right: np.ndarray | None, max_bits: int, found) -> None:
    """Walk pairs of trie nodes of two sorted arrays (or of one with itself) and report close leaves.

    A node is a range of a sorted array whose members share their first bits. ``found``
    gets arrays of positions in left and right. Node pairs whose differing bits exceed the
    budget are dropped with all that lies below them.
    """
    same = right is None
    right = left if same else right
    # ones[t][i]: members before i with bit t set; a node's split is two look-ups.
    def ones(values: np.ndarray, bit: int) -> np.ndarray:
        return np.concatenate([[0], np.cumsum((values >> np.uint64(63 - bit)) & np.uint64(1), dtype=np.int32)]).astype(np.int32)

    left_ones: dict[int, np.ndarray] = {}
    right_ones: dict[int, np.ndarray] = {}

    def leaves(a0, a1, b0, b1):
        wide = (b1 - b0).astype(np.int64)
        sizes = (a1 - a0) * wide
        for at in range(0, len(sizes), FRONTIER):
            part = slice(at, at + FRONTIER)
            owner = np.repeat(np.arange(len(sizes))[part], sizes[part])
            begin = np.cumsum(sizes[part]) - sizes[part]
            inner = np.arange(len(owner)) - np.repeat(begin, sizes[part])
            x = a0[owner] + inner // wide[owner]
            y = b0[owner] + inner % wide[owner]
            if same:
                once = x < y
                x, y = x[once], y[once]
            close = np.bitwise_count(left[x] ^ right[y]) <= max_bits
            found(x[close], y[close])

    stack = [(0, np.array([0], np.int32), np.array([len(left)], np.int32), np.array([0], np.int32),
              np.array([len(right)], np.int32), np.zeros(1, np.int8))]
    while stack:
        bit, a0, a1, b0, b1, spent = stack.pop()
        few = (a1 - a0).astype(np.int64) * (b1 - b0) <= 4
        if bit == 64:
            few[:] = True
        if few.any():
            leaves(a0[few], a1[few], b0[few], b1[few])
            go = ~few
            a0, a1, b0, b1, spent = a0[go], a1[go], b0[go], b1[go], spent[go]
        if not len(a0):
            continue
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            for part in (slice(half, None), slice(half)):
                stack.append((bit, a0[part], a1[part], b0[part], b1[part], spent[part]))
            continue
        if bit not in left_ones:
            left_ones[bit] = ones(left, bit)
            right_ones[bit] = left_ones[bit] if same else ones(right, bit)
        one = left_ones[bit]
        am = a1 - (one[a1] - one[a0])
        one = right_ones[bit]
        bm = b1 - (one[b1] - one[b0])
        kids = []
        for x0, x1, y0, y1, more in ((a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)):
            keep = (x1 > x0) & (y1 > y0) & (spent + more <= max_bits)
            if same:
                keep &= x0 <= y0  # the mirrored pair is walked elsewhere
            kids.append((x0[keep], x1[keep], y0[keep], y1[keep], (spent + more)[keep].astype(np.int8)))
        stack.append((bit + 1, *(np.concatenate(x) for x in zip(*kids))))


def pair_forest(prints: np.ndarray, parts: np.ndarray, first: int, second: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) links of a spanning forest of one pair of subtries."""
    def side(part):
        return np.unique(prints[parts == part])

    left = side(first)
    if first == second:
        forest = Forest(len(left))
        trie_links(left, None, max_bits, forest.join)
        every = left
    else:
        right = side(second)
        every = np.concatenate([left, right])
        forest = Forest(len(every))
        trie_links(left, right, max_bits, lambda x, y: forest.join(x, y + len(left)))
    linked = np.flatnonzero(forest.root != np.arange(len(every)))
    return every[linked], every[forest.root[linked]]


def trie_join(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Distinct fingerprints ``node`` to links (a, b) that connect what lies within ``max_bits``."""
    top = F.shiftrightunsigned("node", 64 - CUT_BITS).cast("int")
    counts = np.zeros(1 << CUT_BITS, np.int64)
    for r in nodes.groupBy(top.alias("top")).count().collect():  # at most 2^CUT_BITS rows
        counts[r["top"]] = r["count"]
    total = int(counts.sum())
    cut = cut_trie(counts, max(1, min(MAX_SUBTRIE, total // MIN_PARTS)))
    first, second = cut_pairs(cut, max_bits)
    part_of = np.zeros(1 << CUT_BITS, np.int32)
    for i, (depth, prefix) in enumerate(cut):
        low = prefix << (CUT_BITS - depth)
        part_of[low:low + (1 << (CUT_BITS - depth))] = i
    ends = np.concatenate([first, second[first != second]])
    pair = np.concatenate([np.arange(len(first)), np.flatnonzero(first != second)])
    order = np.argsort(ends, kind="stable")
    pair, starts = pair[order], np.searchsorted(ends[order], np.arange(len(cut) + 1))

    def deal(batches):
        """Each fingerprint to the pairs of subtries its own subtrie is in."""
        for batch in batches:
            node = np.asarray(batch.column(0)).view(np.uint64)
            if not len(node):
                continue
            part = part_of[(node >> np.uint64(64 - CUT_BITS)).astype(np.int64)]
            for at in range(0, len(node), 4096):
                own = part[at:at + 4096]
                times = starts[own + 1] - starts[own]
                owner = np.repeat(np.arange(len(own)), times)
                inner = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[starts[own[owner]] + inner], pa.int64()),
                     pa.array(node[at:at + 4096][owner].view(np.int64), pa.int64()),
                     pa.array(own[owner], pa.int32())], names=["pair", "node", "part"])

    def walk(table):
        ends_of = pc.min_max(table.column("part")).as_py()
        prints = table.column("node").to_numpy().view(np.uint64)
        a, b = pair_forest(prints, table.column("part").to_numpy(), ends_of["min"], ends_of["max"], max_bits)
        return pa.table({"a": pa.array(a.view(np.int64), pa.int64()), "b": pa.array(b.view(np.int64), pa.int64())})

    def walk_pair(key, table):
        i, j = int(first[key[0].as_py()]), int(second[key[0].as_py()])
        own = pc.unique(table.column("part")).to_pylist()
        if len(own) < (1 if i == j else 2):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return walk(table)

    return (nodes.select("node").mapInArrow(lean(deal), "pair long, node long, part int")
            .groupBy("pair").applyInArrow(lean_group(walk_pair), "a long, b long"))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): connected components of links (a, b), root the least node; linked nodes only.

    Each round: every node points its larger neighbours to its least one (large star),
    then its smaller ones (small star). Both pre-aggregate the least neighbour per node;
    hub nodes meet their links in joins whose large partitions AQE can split.
    """
    def stars(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        met = both.join(least, "a")
        if large:
            out = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    edges, state = saved(links.filter("a <> b").distinct(), "links"), None
    for _ in range(max_rounds):
        step = saved(stars(stars(edges, True), False), "links")
        release(edges)
        edges = step
        # Done when the links are stars: sums over the links no longer change.
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def simhash_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 3) -> DataFrame:
    """Per row: id, fingerprint (hex), component_id, component_node, text_hash. See the module docstring."""
    bound_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("id", F.xxhash64("text").alias("text_hash"), "text")
    kind = docs.schema["id"].dataType.simpleString()
    prints = kept(docs.mapInArrow(lean(fingerprint_rows(shingle)), f"id {kind}, text_hash long, node long"))
    nodes = kept(prints.groupBy("node").agg(F.min("id").alias("least")))
    roots = components(trie_join(nodes, max_bits))
    owned = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = owned.groupBy("root").agg(F.min("least").alias("component_id"))
    by_node = owned.join(least, "root").select("node", "root", "component_id")
    return prints.join(by_node, "node").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"),
        "component_id", F.col("root").alias("component_node"), "text_hash")
