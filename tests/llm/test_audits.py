"""Source divergence, filter interaction audit and line dedup against brute force on small fixtures."""

import itertools
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tessera.llm import filter_audit, line_dedup, source_divergence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string"
EXTRA = ("doc_id long, text string, lang string, source string, key string, h1 int, pos string, line int, cell int, first int, doc int, "
         "term string, shard string, block int, slot int, n string, fails string, digest int, good int, toxic string, rows int, part int")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    lines = ["shared line number one", "SHARED line number two ", "\t shared line number two", "ÄÖÜ shared ünïcode", "short", "a" * 10, "b" * 9,
             "x y shared nbsp line", "mark #1 | in a shared line", ""]
    out = []
    for i in range(60):
        own = [" ".join("".join(rng.choice("abcdeÉß") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 6))]
        text = "\n".join(rng.sample(lines, rng.randint(0, 6)) + own + rng.sample(lines, 2))
        out.append((i, text, rng.choice(["en", "de", None, "fr"]), rng.choice(["s0", "s0", "s1", None, "ſ"])))
    out += [(100 + i, "one hot line in all of them\n" * 3 + "other", "en", "s1") for i in range(40)]
    out += [(200, None, None, None), (201, "", "", ""), (202, "\n\n", "en", "s0"), (203, "one hot line in all of them", "only", "lone"),
            (3, out[3][1], out[3][2], out[3][3]), (4, "shared line number one\nnew text of the same id", "en", "s0"),
            (None, "one hot line in all of them\nno id at all\nno id at all", "en", "s9"), (None, "no id at all", "zz", None),
            (300, "wörd " * 3000 + "\n" + "\n".join(["many lines of it", "few"] * 500), "de", "s2"), (301, "UPPER lower " * 120, "en", "s0"),
            (302, " ".join(f"w{i}" for i in range(250)), "en", "s0"), (303, " ".join(f"w{i}" for i in range(250)), "de", "s0")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(4).cache()


@pytest.fixture(scope="module")
def odd(spark):
    text = "one and the same line\nanother line here"
    return spark.createDataFrame([(i, text, "en", f"s{i % 2}", *["x" if t.endswith("string") else 7 for t in EXTRA.split(", ")[4:]])
                                  for i in range(12)] + [(20, *[None] * (EXTRA.count(",")))], EXTRA)


# Line dedup

def after(i):
    return (i is None, i or 0)


def brute_lines(rows, min_chars=10):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    owner = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                owner[key(line)] = min(owner.get(key(line), after(i)), after(i))
    out = Counter()
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        stay = [owner.get(key(x), after(i)) == after(i) for x in lines]
        runs = [(a, b) for a, b in itertools.combinations(range(len(lines) + 1), 2)
                if all(stay[a:b]) and (a == 0 or not stay[a - 1]) and (b == len(lines) or not stay[b])] if len(lines) < 40 else None
        out[i, len(lines), stay.count(False), "\n".join(x for x, s in zip(lines, stay) if s)] += 1
        if runs is not None:
            out[i, "keep", tuple((a, b - a) for a, b in runs)] += 1
    return out


@pytest.mark.parametrize("least_limit", [1, 20, 1000])   # 1 and 20: hot hashes in cells of their own
def test_lines_equal_brute_force(docs, rows, least_limit):
    expected = brute_lines(rows)
    found = line_dedup.without_repeated_lines(docs, least_limit=least_limit).collect()
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found)
    got += Counter((r.doc_id, "keep", tuple(map(tuple, r.keep))) for r in found if r.n_lines < 40)
    assert got == expected
    bitmaps = line_dedup.keep_bitmaps(docs, least_limit=least_limit).collect()
    assert (Counter((r.doc_id, r.n_lines, r.n_dropped, tuple(r.keep)) for r in bitmaps)
            == Counter((r.doc_id, r.n_lines, r.n_dropped, tuple(r.keep)) for r in found))


def test_hot_hashes_are_found_exactly(spark):
    rows = [(7, 1, i % 50, 0, i) for i in range(400)] + [(7, 2, i, 0, i) for i in range(10)] + [(i, 3, i, 0, 0) for i in range(300)]
    lines = spark.createDataFrame(rows, "h1 long, h2 long, doc long, text_hash long, pos int")
    assert [tuple(r) for r in line_dedup.hot_hashes(lines, 100, 32).collect()] == [(7, 1, 4, 0)]


def test_lines_are_dealt_once_by_range(spark, docs):
    lines = line_dedup.line_hashes(docs, "doc_id", "text", 10)
    plan = line_dedup.later_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning(h1#" not in plan.split("Window")[1].split("rangepartitioning")[0]
    assert "Python" not in plan and "Pandas" not in plan


def test_lines_of_odd_tables(spark, odd):
    assert line_dedup.without_repeated_lines(spark.createDataFrame([], DOCS)).collect() == []
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.without_repeated_lines(odd).collect()}
    assert got == {0: (2, 0), 20: (1, 0)} | {i: (2, 2) for i in range(1, 12)}


# Filter audit

LABELS = "doc_id long, quality int, toxic int"


def brute_audit(rows, labels):
    first, marks = {}, defaultdict(lambda: [False, False])
    for i, text, *_ in rows:
        first[text or ""] = min(first.get(text or "", after(i)), after(i))
    for i, quality, toxic in labels:
        if i is not None:
            marks[i] = [marks[i][0] or quality == 1, marks[i][1] or toxic == 1]
    judged = defaultdict(list)
    for i, text, lang, _ in rows:
        text = text or ""
        w = WORD.findall(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 "D": bool(re.search(r"[#$%&*|]", text)), "E": first[text] < after(i)}
        judged[lang or ""].append((fails, *(marks[i] if i is not None else (False, False))))
    out, shapley = [], Counter()
    for part, found in judged.items():
        for order in itertools.permutations("ABCDE"):
            left = list(range(len(found)))
            for step, f in enumerate(order, 1):
                gone = [k for k in left if found[k][0][f]]
                left = [k for k in left if not found[k][0][f]]
                shapley[part, f] += len(gone)
                failing = sum(x[0][f] for x in found)
                earlier = failing - len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), earlier, sum(x[0][f] and sum(x[0].values()) == 1 for x in found),
                            sum(found[k][1] for k in gone), sum(found[k][2] for k in gone), f))
    return Counter((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def test_audit_equals_brute_force(spark, docs, rows):
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(0, 310, 3)] + [(6, 1, None), (None, 1, 1), (9, None, 1), (9, 0, 0), (12, 0, 0)]
    found = filter_audit.filter_audit(docs, spark.createDataFrame(labels, LABELS))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert Counter(map(tuple, found.collect())) == brute_audit(rows, labels)


def test_removal_ranks_are_min_plus_products():
    orders, places, ranks = filter_audit.removal_ranks(4)
    assert ranks.shape == (16, 24)
    for (o, order), mask in itertools.product(enumerate(orders), range(16)):
        failing = [step for step, f in enumerate(order, 1) if mask >> f & 1]
        assert ranks[mask, o] == (min(failing) if failing else 5)
        assert all(order[places[o, f] - 1] == f for f in range(4))


def test_audit_of_odd_tables(spark, odd):
    labels = spark.createDataFrame([(1, 1, 1, "x")], LABELS + ", part string")
    assert filter_audit.filter_audit(spark.createDataFrame([], DOCS), labels).count() == 0
    got = filter_audit.filter_audit(odd, labels.limit(0)).filter("filter_order = 'EABCD'").collect()
    assert {(r.part, r.step): r.removed for r in got if r.step < 3} == {("en", 1): 11, ("en", 2): 1, ("", 1): 0, ("", 2): 1}


# Source divergence

def brute_divergence(rows, min_docs, top):
    occurring, by_lang, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall(lower(text or ""))
        groups.add((lang, source))
        occurring[lang, source].update(terms)
        by_lang[lang].update(set(terms))
    out = []
    for lang in by_lang.keys() | {g[0] for g in groups}:
        kept = sorted(t for t, n in by_lang[lang].items() if n >= min_docs)
        sources = sorted(s for x, s in groups if x == lang)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + (10 ** 9 * (count[t] + 2)) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(occurring[lang, s]) for s in sources}
        q = shares(sum((occurring[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [("pair", o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            own = [("term", t, f(p[s][t], q[t])) for t in kept if occurring[lang, s][t] and p[s][t] > q[t]]
            for found, cut in ((pairs, None), (own, top)):
                for rank, (part, item, value) in enumerate(sorted(found, key=lambda x: (-x[2], x[1].encode()))[:cut], 1):
                    out.append((lang, s, part, item, value, rank))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"min_docs": 3}, {"min_docs": 2, "top": 3, "shard_terms": 8}, {"min_docs": 2, "shard_terms": 4, "block_bytes": 400}])
def test_divergence_equals_brute_force(docs, rows, options):
    found = source_divergence.source_divergence(docs, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == brute_divergence(rows, options.get("min_docs", 10), options.get("top", 10))


def test_divergence_of_odd_tables(spark, odd):
    assert source_divergence.source_divergence(spark.createDataFrame([], DOCS)).count() == 0
    got = source_divergence.source_divergence(odd).collect()
    assert {(r.lang, r.source, r.part, r.item) for r in got if r.part == "pair"} == {("en", "s0", "pair", "s1"), ("en", "s1", "pair", "s0")}


def test_perfect_hash_is_minimal_and_checks_stored_terms():
    rng = np.random.default_rng(1)
    terms = [f"term{i}é".encode() for i in range(5000)]
    hashes = source_divergence.term_hashes(terms)
    hashes[:3] = hashes[10]                                     # equal hashes of different terms
    made = source_divergence.PerfectHash.build(hashes, source_divergence.utf8(terms))
    order = rng.permutation(5000)
    slots = made.slots(hashes[order], source_divergence.utf8([terms[i] for i in order]))
    assert sorted(slots) == list(range(5000))
    assert made.terms.take(pa.array(slots)).to_pylist() == [terms[i].decode() for i in order]
    strange = [b"nope%d" % i for i in range(2000)]
    assert (made.slots(source_divergence.term_hashes(strange), source_divergence.utf8(strange)) == -1).all()
    assert (made.slots(hashes[:100], source_divergence.utf8([b"x"] * 100)) == -1).all()
    one = source_divergence.PerfectHash.build(hashes[:1], source_divergence.utf8(terms[:1]))
    assert one.slots(hashes[:1], source_divergence.utf8(terms[:1])).tolist() == [0]


def test_hashes_are_sparks(spark):
    terms = ["a", "straße", "x" * 100]
    found = spark.createDataFrame([(t,) for t in terms], "t string").selectExpr("xxhash64(t) AS h").collect()
    assert [r.h % 2 ** 64 for r in found] == [xxhash.xxh64_intdigest(t.encode(), source_divergence.SEED) for t in terms]


def test_shares_are_exact_beyond_64_bit_products():
    counts = np.array([0, 1, 10 ** 12, 4 * 10 ** 14, 10 ** 15 - 1], np.int64)
    total, v = 2 * 10 ** 15, 10 ** 8
    assert source_divergence.shares(counts, total, v).tolist() == [1 + (10 ** 9 * (int(c) + 2)) // (total + 2 * v) for c in counts]
    assert Decimal(int(source_divergence.shares(np.array([5]), 5, 1)[0])) == 1 + 10 ** 9
    with pytest.raises(OverflowError):
        source_divergence.shares(counts, 10 ** 16, v)
