"""Edge cases and brute force on small fixtures, operator by operator."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from tessera.llm import (decontamination, hidden_markov, mixing, nearest, simhash, substring_dedup, token_files, toxicity,
                         url_filters, warc_zip)
from tessera.llm.queries import END_ID, URL_RULES, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "doc_id long, text string, source string, id string, key string, size int, node int, words string, chunk int"


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark):
    passage = words(70, 99)
    rows = [(i, " ".join(words(30 + 7 * i, i)), "en", f"s{i % 3}", None) for i in range(30)]
    rows += [(100 + i, " ".join(words(20, 200 + i) + passage + words(15, 300 + i)), "en", None, 1) for i in range(12)]
    rows += [(200 + i, rows[5][1], "de", "s0", 1) for i in range(20)]                       # exact copies
    rows += [(300 + i, rows[6][1] + f" tail{i}", "de", "s1", 1) for i in range(5)]          # near copies
    rows += [(350 + i, " ".join(words(9, 800 + i) + ["on", "and"] * (40 + 3 * i) + words(9, 850 + i)), "en", "s2", 1) for i in range(6)]
    rows += [(400, None, None, None, None), (401, "", "x", "s9", 0), (402, " \t\n", None, "s9", 0), (403, "one", "en", "s2", 3),
             (404, "Ünï\u00a0çode\u0085 ΣΑΣ <|endoftext|>x", "en", "s2", 3), (404, "Ünï\u00a0çode\u0085 ΣΑΣ <|endoftext|>x", "en", "s2", 3),
             (405, " ".join(words(30_000, 7)), "en", "s1", 1), (None, "no id here", "en", "s1", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


def texts_of(corpus):
    return {(r.doc_id, r.text): [w.encode() for w in WORD.findall(r.text or "")] for r in corpus.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Extra columns whose names clash with the operators' own."""
    rows = [(1, "alpha beta gamma delta", "s", "x", "y", 3, 4, "w", 5), (2, "alpha beta gamma delta", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, EXTRA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# Toxicity

def toxic_tables(spark, n=400):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        own, bad = words(40, 1000 + i), i % 6 == 0
        if bad:
            for _ in range(4):
                own.insert(rng.randrange(len(own)), rng.choice(["idiot,", "zorgling", "Zorgfest", "zorgul"]))
        rows.append((i, " ".join(own)))
        if i % 4:
            labels.append((i, int(bad)))
    rows += [(9000, None), (9001, ""), (9002, "zorgling idiot zorgul " * 5000), (None, "idiot zorgling"), (3, rows[3][1])]
    labels += [(5, None), (None, 1), (7, 0), (7, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_finds_held_out_toxic_rows(spark):
    docs, labels = toxic_tables(spark)
    found = toxicity.toxicity(docs, labels)
    rows = found.frame.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    wrong = [r.doc_id for r in rows if r.doc_id is not None and r.doc_id < 9000 and r.predicted != int(r.doc_id % 6 == 0)]
    assert len(wrong) <= 4
    by_id = {r.doc_id: r.predicted for r in rows}
    assert by_id[9000] == by_id[9001] == 0 and by_id[9002] == 1 and by_id[None] == 1


def test_toxicity_without_labels_or_rows(spark, odd, empty):
    docs, labels = toxic_tables(spark, 60)
    rows = toxicity.toxicity(docs, labels.limit(0)).frame.collect()
    assert len(rows) == docs.count()
    assert toxicity.toxicity(empty, labels).frame.count() == 0
    assert toxicity.toxicity(odd, labels).frame.count() == 2


def test_label_model_learns_accuracies_and_correlation():
    rng = np.random.default_rng(0)
    n, v = 20_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.2
    votes = np.zeros((n, v), int)
    for k in range(4):
        votes[:, k] = np.where(y, rng.random(n) < 0.8, rng.random(n) < 0.03)
    votes[:, 4] = np.where(rng.random(n) < 0.95, votes[:, 0], 1 - votes[:, 0])  # a near copy of voter 0
    codes = (votes << np.arange(v)).sum(axis=1)
    patterns, counts = np.unique(codes, return_counts=True)
    zero = np.zeros(len(patterns))
    model = toxicity.fit_label_model(patterns, counts.astype(float), zero, zero, toxicity.Config())
    assert abs(model.prior - 0.2) < 0.03
    assert abs(model.accuracies[toxicity.VOTERS[1]][1] - 0.8) < 0.06
    assert any({0, 4} <= set(c) for c in model.cliques)
    guess = dict(zip(patterns, model.posterior(patterns) > 0.5))
    assert np.mean([guess[c] == t for c, t in zip(codes, y)]) > 0.97


# URL filters

def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fit = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


def test_url_verdicts_equal_brute_force(spark):
    rules = URL_RULES + [url_filters.Rule("allow", "a.b.c", "/x"), url_filters.Rule("block", "a.b.c", "/x"),
                         url_filters.Rule("block", "a.b.c", "/x/y/"), url_filters.Rule("allow", "b.c", ""), url_filters.Rule("block", "é.org", "/ü")]
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/En/", "http://example.net/en/x?y#z",
            "http://x.example.net:80/en/", "http://notexample.net/en/", "http://www.example.com/de/1", "http://q.org/fr/", "http://q.org/FR/",
            "x://a.b.c/x/y/z", "x://a.b.c/x/yz", "x://z.a.b.c/xx", "x://b.c", "x://b.c?q", "x://ab.c/", "x://é.org/ü/1", "x://É.org/ü",
            "x://" + "a." * 3000 + "net/" + "p" * 5000, "x://.net/", "x://net./", "x://a://net/", "://net/?://x"] * 3
    pages = spark.createDataFrame([(None if i % 7 == 0 else i // 2, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = Counter(tuple(r) for r in url_filters.url_verdicts(pages, rules).collect())
    assert got == Counter((None if i % 7 == 0 else i // 2, *brute_verdict(u, rules)) for i, u in enumerate(urls))


def test_url_verdicts_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filters.url_verdicts(pages, []).collect()] == [(1, "net", "/", None, "allow")]
    assert url_filters.url_verdicts(pages.limit(0), URL_RULES).count() == 0


def test_url_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    plan = url_filters.url_verdicts(pages, URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Substring dedup

def brute_kept(rows, window):
    first = {}
    for number, own in sorted((r, w) for r, w in rows if r is not None):
        for i in range(len(own) - window + 1):
            first.setdefault(tuple(own[i:i + window]), number)
    out = []
    for number, own in rows:
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if number is not None and first[tuple(own[i:i + window])] < number:
                gone[i:i + window] = [True] * window
        out.append((number, len(own), sum(gone), b" ".join(w for w, g in zip(own, gone) if not g).decode()))
    return Counter(out)


@pytest.mark.parametrize("hot,contents", [(4096, 20_000), (3, 20_000), (0, 4), (0, 0)])
@pytest.mark.parametrize("window,gram", [(50, 8), (12, 4)])
def test_repeats_equal_brute_force(corpus, hot, contents, window, gram):
    config = substring_dedup.Config(window=window, gram=gram, hot=hot, contents=contents, shard_words=3_000)
    got = Counter(tuple(r) for r in substring_dedup.without_repeats(corpus, config=config).collect())
    rows = [(r.doc_id, [w.encode() for w in WORD.findall(r.text or "")]) for r in corpus.collect()]
    assert got == brute_kept(rows, window)


def test_repeats_of_empty_and_odd_tables(empty, odd):
    assert substring_dedup.without_repeats(empty).count() == 0
    assert substring_dedup.without_repeats(odd).count() == 2


def test_fm_index_equals_brute_force():
    rng = np.random.default_rng(1)
    for reach in (1, 3, 4, 5, 50):
        texts = [rng.integers(1, 4, rng.integers(1, 90)) for _ in range(10)]
        owners = rng.integers(0, 100, 10)
        index = substring_dedup.FMIndex(texts, owners, reach)
        queries = texts[:3] + [rng.integers(1, 6, rng.integers(1, 90)) for _ in range(5)]
        for query, got in zip(queries, index.least_owners(queries)):
            want = []
            for p in range(len(query) - reach + 1):
                part = query[p:p + reach].tolist()
                held = [o for t, o in zip(texts, owners) if any(t[s:s + reach].tolist() == part for s in range(len(t) - reach + 1))]
                want.append(min(held, default=-1))
            assert got.tolist() == want


# Nearest neighbours

def brute_nearest(rows, queries, k):
    out = set()
    for q, v in queries:
        scored = sorted(((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
        out |= {(q, rank, i) for rank, (_, i) in enumerate(scored, 1)}
    return out


def test_nearest_handles_unusable_vectors_and_ties(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.standard_normal(8).round(3).tolist()) for i in range(60)]
    good += [(100 + i, good[3][1]) for i in range(30)] + [(200, [1.0, 2.0]), (201, [2.0, 1.0])]
    bad = [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] * 4), (304, [float("nan")] * 8), (305, [float("inf")] * 8),
           (None, good[0][1])]
    table = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id long, embedding array<float>, id int")
    asked = [0, 3, 104, 200, 300, 304]
    got = nearest.nearest(table, table.filter(table.vec_id.isin(asked)), k=20).collect()
    exact = [(i, np.array(v, np.float32).astype(float)) for i, v in good]
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == brute_nearest(exact, [x for x in exact if x[0] in asked], 20)
    assert nearest.nearest(table.limit(0), table.limit(0)).count() == 0


def test_nearest_recall_where_windows_stop_early(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((3_000, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    config = nearest.Config(block=1_500, query_block=40)
    got = nearest.nearest(table, table.filter("vec_id % 50 = 0"), config=config).collect()
    rows = list(enumerate(vectors))
    want = brute_nearest(rows, rows[::50], 20)
    assert len(got) == 20 * 60
    assert nearest.nearest(table, table.filter("vec_id % 50 = 0"), config=config).count() == 20 * 60
    hit = {(q, i) for q, _, i in want} & {(r.query_id, r.vec_id) for r in got}
    assert len(hit) / len(want) >= 0.9


@pytest.mark.parametrize("norms", ["unit", "log-normal 0.3", "log-normal 0.7", "one of 5", "one of 10", "a hundredth of 5"])
def test_nearest_recall_whatever_the_norms(norms):
    rng = np.random.default_rng(3)
    n, asked = 8_192, np.arange(0, 8_192, 200)
    vectors = rng.standard_normal((n, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    kind, _, size = norms.rpartition(" ")
    if kind == "log-normal":
        vectors *= np.exp(float(size) * rng.standard_normal(n))[:, None]
    elif kind:
        vectors[rng.permutation(n)[:1 if kind == "one of" else n // 100]] *= float(size)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    index = nearest.Index(vectors, nearest.Config())
    found = list(index.search(np.arange(n), asked, vectors[asked], 20))
    assert np.mean([len(set(got) & set(want[number])) / 20 for number, got, _ in found]) >= 0.9
    assert index.verified / index.asked <= 0.1 * n


@pytest.mark.parametrize("folder, most", [("sf0.01", 0.3), ("sf0.1", 0.1)])
def test_nearest_windows_decide_on_the_given_tables(spark, folder, most):
    """Recall against brute force, and the share of vectors verified: windows run, no table is searched whole."""
    table = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").orderBy("vec_id").toPandas()
    vectors = np.stack(table["embedding"].to_numpy()).astype(float)
    asked = np.arange(0, len(vectors), 20)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    index = nearest.Index(vectors, nearest.Config())
    found = list(index.search(np.arange(len(vectors)), asked, vectors[asked], 20))
    assert np.mean([len(set(got) & set(want[number])) / 20 for number, got, _ in found]) >= 0.93
    assert 0 < index.verified / index.asked <= most * len(vectors)


@pytest.mark.parametrize("dim, n", [(1, 300), (2, 900), (5, 2_000), (300, 2_000)])
def test_nearest_in_few_and_many_dimensions(dim, n):
    vectors = np.random.default_rng(5).standard_normal((n, dim))
    vectors[7] = vectors[11]
    asked = np.arange(0, n, 40)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    want = np.sort(scores, axis=1)[:, ::-1][:, :20]
    found = list(nearest.Index(vectors, nearest.Config()).search(np.arange(n), asked, vectors[asked], 20))
    assert np.mean([np.mean(s >= want[number][-1] - 1e-9) * len(s) / 20 for number, _, s in found]) >= 0.9


def test_collisions_are_counted_in_every_array():
    vectors = np.random.default_rng(6).standard_normal((500, 16))
    index = nearest.Index(vectors, nearest.Config(arrays=40))
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    for width in (0.02, 0.1, 0.5, 3.0):
        far = np.abs((units - units[3]) @ index.lines)
        assert (index.collisions(units[3:4] @ index.lines, width) == (far <= width).sum(axis=1)).all()


# Mixing

def test_targets_share_excess_by_weight():
    got = mixing.targets({"b": 100, "a": 10, None: 0, "c": 50})
    # a weighs 3, b 1, c 2, NULL 3 of 240 words: a and NULL stop at 20 and 0, the rest by 1 to 2, c stops at 100.
    assert got == {"a": 20, None: 0, "c": 100, "b": 120}
    assert mixing.targets({}) == {}


def test_mix_meets_targets_and_reruns_agree(corpus):
    first = [tuple(r) for r in mixing.mix(corpus).collect()]
    again = [tuple(r) for r in mixing.mix(corpus.repartition(3)).collect()]
    assert Counter(first) == Counter(again) and len(first) == corpus.count()
    rows = mixing.mix(corpus).collect()
    sizes = Counter()
    for r in corpus.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = mixing.targets(dict(sizes))
    for source in sizes:
        own = [r for r in rows if r.source == source]
        assert all(r.source_size == sizes[source] and r.target == float(want[source]) for r in own)
        assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in own)
        if want[source]:
            # One text of this corpus is far longer than its whole source besides.
            assert abs(sum(r.taken for r in own) - want[source]) <= max(0.02 * want[source], max(r.size for r in own) / 2)


def test_newton_finds_the_tilt():
    dual = mixing.Dual(150.0, 100, 2.0)
    sizes, counts = np.array([1.0, 2.0, 5.0]), np.array([10, 20, 10])
    for _ in range(100):
        if dual.done:
            break
        rate = np.minimum(2, np.exp(dual.value * sizes / dual.mean))
        dual.update(float((counts * sizes * rate).sum()), float((counts * sizes * sizes / dual.mean * rate * (rate < 2)).sum()))
    assert dual.done and abs((counts * sizes * np.minimum(2, np.exp(dual.value * sizes / dual.mean))).sum() - 150) < 1e-2


def test_mixed_documents_repeat_rows(corpus, odd, empty):
    plan = Counter()
    for r in mixing.mix(corpus).collect():
        plan[r.doc_id] += r.copies
    rows = mixing.mixed_documents(corpus).collect()
    assert Counter(r.doc_id for r in rows) == +plan
    assert rows[0].__fields__ == corpus.columns
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


# SimHash

def brute_fingerprint(text):
    own = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = WORD.findall(own)
    shingles = [" ".join(own[i:i + 3]) for i in range(len(own) - 2)] if len(own) >= 3 else [" ".join(own)] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def up(n):
        while root[n] != n:
            n = root[n]
        return n
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[max(up(a), up(b))] = min(up(a), up(b))
    return {n: up(n) for n in nodes}


def test_simhash_equals_brute_force(corpus):
    rows = corpus.collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    root = brute_components(prints, 3)
    least = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            least[root[p]] = min(r.doc_id, least.get(root[p], r.doc_id))
    want = Counter((r.doc_id, f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints))
    assert Counter(tuple(r)[:3] for r in simhash.simhash_groups(corpus).collect()) == want


def test_fingerprint_equals_spark_hash(spark):
    r = spark.sql("SELECT xxhash64('a bb ccc') AS h").first()
    assert simhash.fingerprint_of(b"a bb  ccc") == r.h % (1 << 64)


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_trie_join_equals_all_pairs(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = [base]
    for _ in range(6):
        near = base[:60].copy()
        for _ in range(int(rng.integers(1, 5))):
            near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
        flips.append(near)
    chain = np.array([(1 << k) - 1 for k in range(0, 60, 2)], np.uint64)
    prints = np.unique(np.concatenate([*flips, chain]))
    nodes = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "node long")
    got = {r.node: r.root for r in simhash.components(simhash.trie_join(nodes, bits)).collect()}
    want = brute_components([int(p) for p in prints], bits)
    as_long = lambda x: int(np.uint64(x).view(np.int64))
    groups = {}
    for n in want:
        groups.setdefault(want[n], set()).add(as_long(n))
    for members in groups.values():
        assert len({got.get(m, m) for m in members}) == 1
    assert len({got.get(as_long(n), as_long(n)) for n in want}) == len(groups)


def test_simhash_of_empty_and_odd_tables(empty, odd):
    assert simhash.simhash_groups(empty).count() == 0
    assert {r.component_id for r in simhash.simhash_groups(odd).collect()} == {1}


# Decontamination

def test_decontamination_tolerates_substitutions(spark):
    item, short, tiny = words(40, 1), words(8, 2), words(3, 3)
    replaced = [w if i % 9 else "zzz" for i, w in enumerate(item)]
    half = item[10:24]
    bench = spark.createDataFrame([(1, " ".join(item), 0), (2, " ".join(short), 0), (3, " ".join(tiny), 0), (4, None, 0), (5, "", 0),
                                   (6, " ".join(item), 0)], "item_id long, text string, id int")
    pad = lambda n, own: " ".join(words(60, n) + own + words(50, n + 1))
    docs = [(1, pad(10, item), True), (2, pad(20, [w.upper() + "," for w in item]), True), (3, pad(30, replaced), True),
            (4, pad(40, half), True), (5, pad(50, item[:8]), False), (6, pad(60, short), True), (7, pad(70, tiny), False),
            (8, None, False), (9, "", False), (10, " ".join(item), True), (11, pad(80, item[::-1]), False),
            (12, " ".join(words(40_000, 5) + item), True), (None, pad(90, item), True), (10, " ".join(item), True)]
    table = spark.createDataFrame(docs, "doc_id long, text string, item_id boolean").repartition(3)
    for most in (500_000, 50):
        got = decontamination.contamination(table, bench, block_seeds=most).collect()
        assert Counter((r.doc_id, r.contaminated) for r in got) == Counter((a, c) for a, _, c in docs)
        assert next(r for r in got if r.doc_id == 1).item_ids == [1, 6]
    clean = decontamination.clean_documents(table, bench).collect()
    assert Counter(r.doc_id for r in clean) == Counter(a for a, _, c in docs if not c)
    assert decontamination.contamination(table, bench.limit(0)).filter("contaminated").count() == 0
    assert decontamination.contamination(table.limit(0), bench).count() == 0


def test_every_substitution_pattern_at_a_fifth_leaves_a_hit(spark):
    rng = random.Random(0)
    item = words(45, 1)
    rows = []
    for n in range(60):
        own = list(item)
        for at in rng.sample(range(45), 4):
            own[at] = "zzz"
        rows.append((n, " ".join(words(10, n) + own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert decontamination.contamination(docs, bench).filter("contaminated").count() == 60


def test_longest_run_equals_brute_force():
    rng = np.random.default_rng(0)
    for n in [0, 1, 2, 13, 16, 40] * 20:
        agree = rng.random(n) < rng.choice([0.5, 0.8, 0.95])
        runs = [(j - i, int(agree[i:j].sum())) for i in range(n + 1) for j in range(i, n + 1) if 5 * agree[i:j].sum() >= 4 * (j - i)]
        start, length, agreeing = decontamination.longest_run(agree)
        assert (length, agreeing) == max(runs) and agree[start:start + length].sum() == agreeing


@pytest.mark.parametrize("size", [13, 16, 20, 40])
def test_decontamination_finds_items_up_to_a_fifth_replaced(spark, size):
    rng = random.Random(size)
    item = words(size, size)
    periodic = [set(range(first, size, 5)) for first in range(5) if len(range(first, size, 5)) <= size // 5]
    patterns = [{at} for at in range(size)] + periodic
    patterns += [set(rng.sample(range(size), n)) for n in (max(1, size // 10), size // 5) for _ in range(60)]
    rows = [(n, " ".join(words(10, n) + ["zzz" if at in p else w for at, w in enumerate(item)] + words(10, 900 + n)))
            for n, p in enumerate(patterns)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontamination.contamination(docs, bench)
    assert [r.doc_id for r in got.filter("NOT contaminated").collect()] == []


def test_decontamination_finds_short_items_up_to_a_fifth_replaced(spark):
    items = {size: words(size, size) for size in range(5, 13)}
    rows = []
    for size, item in items.items():
        for pattern in itertools.combinations(range(size), size // 5 if size >= 8 else 0):
            own = ["zzz" if at in pattern else w for at, w in enumerate(item)]
            rows.append((len(rows), " ".join(words(10, len(rows)) + own + words(10, 900 + len(rows))), size))
    docs = spark.createDataFrame(rows, "doc_id long, text string, size long")
    bench = spark.createDataFrame([(size, " ".join(item)) for size, item in items.items()], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination.contamination(docs, bench).collect()}
    assert [n for n, _, size in rows if size not in got[n]] == []


# WARC in ZIP

def test_warc_round_trip(spark):
    bodies = ["<html>a</html>", None, "", "é" * 10, "\r\n\r\nWARC/1.1\r\n", "x" * 300_000]
    rows = [(i, f"http://h/{i}\r\nX: ü y", bodies[i % 6], "z") for i in range(60)] + [(None, None, bodies[0], "z"), (60, None, "only", "z"),
                                                                                      (54, "u", bodies[0], "z"), (None, "u", "nobody", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(4)
    top = {}
    for i, _, b, _ in rows:
        top[b or ""] = max([x for x in (i, top.get(b or "")) if x is not None], default=None)
    want = Counter()
    for i, _, b, _ in rows:
        raw, holder = (b or "").encode(), top[b or ""]
        own = i == holder
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if own else "revisit", None if own else holder)] += 1
    for size in (1 << 29, 100_000):
        packages = warc_zip.write_packages(pages, package_bytes=size)
        assert Counter(tuple(r) for r in warc_zip.read_packages(packages).collect()) == want
    apart = warc_zip.read_packages(warc_zip.write_packages(pages, min_revisit=1)).collect()
    assert all(r.record_type == "response" for r in apart if r.payload_bytes == 0)
    assert warc_zip.read_packages(warc_zip.write_packages(pages.limit(0))).count() == 0


def test_zip64_and_foreign_members(tmp_dir):
    import struct
    import zipfile
    path = f"{tmp_dir}/a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("packed.txt", b"x" * 500, zipfile.ZIP_DEFLATED)
        z.writestr(warc_zip.DATA, b"stored bytes")
        z.comment = b"a PK comment"
    package = warc_zip.Package(path)
    assert "packed.txt" not in package.members
    assert package.read(*package.place(warc_zip.DATA)) == b"stored bytes"
    # The same archive with a ZIP64 directory: 32-bit fields full, the wide ones in the extra field.
    name, data = b"archive/data.warc.gz", b"wide"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, zlib.crc32(data), 2**32 - 1, 2**32 - 1, len(name), 20) + name
    local += struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    wide = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    entry = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, zlib.crc32(data), 2**32 - 1, 2**32 - 1,
                        len(name), len(wide), 0, 0, 0, 0, 2**32 - 1) + name + wide
    at = len(local)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(entry), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 2**32 - 1, 2**32 - 1, 0)
    with open(path, "wb") as f:
        f.write(local + entry + end64 + locator + end)
    package = warc_zip.Package(path)
    assert package.read(*package.place(warc_zip.DATA)) == b"wide"


# Token files

def whole_ids(text):
    from tokenizers import Tokenizer
    return [*Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids, END_ID]


@pytest.mark.parametrize("per_word,most", [(True, 1 << 27), (True, 300), (False, 1 << 27)])
def test_token_files_round_trip(corpus, per_word, most):
    files = token_files.write_token_files(corpus, tokenizer_path(), END_ID, per_word=per_word, file_ids=most)
    got = token_files.read_token_files(files).collect()
    rows = sorted(corpus.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert len(got) == len(rows)
    want, start = [], 0
    for r in rows:
        ids = whole_ids(r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_file_random_access(corpus):
    files = token_files.write_token_files(corpus, tokenizer_path(), END_ID, per_word=True).collect()
    texts = {r.doc_id: r.text for r in corpus.collect()}
    seen = 0
    for f in files:
        file = token_files.TokenFile(f.path)
        for i in range(file.docs):
            assert file.document(i).tolist() == whole_ids(texts[file.key(i)])
            seen += 1
        file.close()
    assert seen == corpus.count()


def test_word_encoding_equals_whole_texts():
    encoder, plain = token_files.Encoder(tokenizer_path(), True), token_files.Encoder(tokenizer_path(), False)
    odd = ["don't  STOP it's", "a<|startoftext|>b <|startoftext|>", "<|endoftext|> x<|endoftext|>", "e\u0301 \u0301x A\u030a", "\u2003x\u00a0y\u0085z",
           "12 3.4,5 'll we'll 'S", "ΑΣ ΣΑ İ ß ﬁ", "日本 語", "\x1c a\x1db \x00", "😀😀 👩‍👩", "", " \n\t\x0b\x0c\r "]
    rng = random.Random(1)
    alphabet = "abzABZ019'’.,-é\u0301Σ日😀<|>\u00a0\u200b \n\t"
    odd += ["".join(rng.choice(alphabet) for _ in range(200)) for _ in range(200)]
    raw = [x.encode() for x in odd]
    assert encoder.encode(raw) == plain.encode(raw)


def test_words_of_the_given_tables_encode_as_whole_texts(spark):
    """Every distinct word of all documents of sf0.1, and whole documents, both ways."""
    texts = [(r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    encoder, plain = token_files.Encoder(tokenizer_path(), True), token_files.Encoder(tokenizer_path(), False)
    assert encoder.model is not None
    words_ = sorted(set().union(*(t.split() for t in texts)))
    for at in range(0, len(words_), 20_000):
        some = words_[at:at + 20_000]
        assert encoder.encode(some) == plain.encode(some)
    assert encoder.encode(texts[::10]) == plain.encode(texts[::10])


def test_other_settings_use_the_whole_tokenizer(tmp_path):
    import json
    made = json.loads(open(tokenizer_path()).read())
    made["normalizer"]["normalizers"] = made["normalizer"]["normalizers"][:2]     # no lower case
    (tmp_path / "other.json").write_text(json.dumps(made))
    encoder = token_files.Encoder(str(tmp_path / "other.json"), True)
    assert encoder.model is None


@pytest.mark.parametrize("values,universe", [([], 0), ([0], 0), ([0, 0, 0], 0), ([5], 5), ([0, 1, 1, 7, 1000], 1000), ([3] * 2000, 10 ** 6)])
def test_elias_fano_small(values, universe):
    check_elias_fano(np.array(values, np.int64), universe)


def check_elias_fano(values, universe):
    made = token_files.EliasFano.of(values, universe)
    read = token_files.EliasFano.frombytes(made.tobytes(), len(values), universe)
    assert read.all().tolist() == values.tolist()
    for i in range(0, len(values), max(1, len(values) // 300)):
        assert read[i] == values[i]


def test_elias_fano_random():
    rng = np.random.default_rng(0)
    for universe in (10, 5_000, 1 << 40):
        values = np.sort(rng.integers(0, universe, 3_000))
        check_elias_fano(values, universe)
        bits = 8 * len(token_files.EliasFano.of(values, universe).tobytes()) / len(values)
        assert bits <= 2.2 + max(0, math.log2(universe / len(values)) + 1)


def test_token_files_of_empty_and_odd_tables(empty, odd):
    assert token_files.read_token_files(token_files.write_token_files(empty, tokenizer_path(), END_ID)).count() == 0
    assert token_files.read_token_files(token_files.write_token_files(odd, tokenizer_path(), END_ID, per_word=True)).count() == 2


# Hidden Markov model

def slow_likelihood(doc, model):
    alpha, total = None, 0.0
    for c in doc:
        alpha = model.emit[c] * (model.start if alpha is None else alpha @ model.move)
        total += math.log10(alpha.sum())
        alpha = alpha / alpha.sum()
    return total


def random_model(rng, states, classes):
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return hidden_markov.Model(norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((classes, states)), 0))


def test_forward_is_exact():
    rng = np.random.default_rng(0)
    model = random_model(rng, 3, 5)
    docs = [rng.integers(0, 5, n) for n in (1, 7, 300, 2, 7)]
    got = hidden_markov.forward_scores(docs, model)
    assert np.allclose(got, [slow_likelihood(d, model) for d in docs])
    # Against the sum over all state paths.
    import itertools
    short = [1, 4, 0, 2]
    every = sum(model.start[p[0]] * model.emit[short[0], p[0]] *
                math.prod(model.move[a, b] * model.emit[c, b] for a, b, c in zip(p, p[1:], short[1:]))
                for p in itertools.product(range(3), repeat=4))
    assert abs(hidden_markov.forward_scores([np.array(short)], model)[0] - math.log10(every)) < 1e-9


def test_expected_counts_equal_brute_force():
    rng = np.random.default_rng(1)
    model = random_model(rng, 2, 4)
    pieces = [rng.integers(0, 4, n) for n in (5, 3, 1)]
    emissions, moves, starts, likelihood = hidden_markov.expected_counts(pieces, np.array([True, True, True]), model)
    import itertools
    want_e, want_m, want_s, want_l = np.zeros((4, 2)), np.zeros((2, 2)), np.zeros(2), 0.0
    for doc in pieces:
        paths = {}
        for p in itertools.product(range(2), repeat=len(doc)):
            paths[p] = model.start[p[0]] * math.prod(model.emit[c, s] for c, s in zip(doc, p)) * math.prod(model.move[a, b] for a, b in zip(p, p[1:]))
        total = sum(paths.values())
        want_l += math.log10(total)
        for p, x in paths.items():
            want_s[p[0]] += x / total
            for c, s in zip(doc, p):
                want_e[c, s] += x / total
            for a, b in zip(p, p[1:]):
                want_m[a, b] += x / total
    assert np.allclose(emissions, want_e, atol=1e-4) and np.allclose(moves, want_m, atol=1e-4) and np.allclose(starts, want_s, atol=1e-4)
    assert abs(likelihood - want_l) < 1e-3


def test_language_model_counts_equal_brute_force(corpus):
    for chunk in (2_000_000, 500):
        config = hidden_markov.Config(chunk=chunk, batch=5_000, piece=32, classes=64, rounds=3)
        found = hidden_markov.language_model(corpus, config=config)
        rows = corpus.collect()
        tokens = [[w.encode().lower() for w in WORD.findall(r.text or "")] + [hidden_markov.END] for r in rows]
        held = [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows]
        counts = Counter()
        for own, out in zip(tokens, held):
            if not out:
                counts.update(own)
        n, v = sum(counts.values()), len(counts)
        kinds, totals, vocabulary = {}, Counter(), Counter()
        for w in {w for own in tokens for w in own}:
            kinds[w] = config.classes if w == hidden_markov.END else zlib.crc32(w) % config.classes
        for w, c in counts.items():
            totals[kinds[w]] += c
            vocabulary[kinds[w]] += 1
        want = Counter()
        for r, own, out in zip(rows, tokens, held):
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
            score = slow_likelihood([kinds[w] for w in own], found.model) + sum(
                math.log10((counts[w] + 1) / (totals[kinds[w]] + vocabulary[kinds[w]] + 1)) for w in own)
            want[(r.doc_id, out, len(own), sum(counts[w] > 0 for w in own), n, round(base, 4), round(score, 3))] += 1
        got = Counter((*tuple(r)[:5], round(r.base_score, 4), round(r.score, 3)) for r in found.frame.collect())
        assert sum((got & want).values()) >= sum(want.values()) - 2  # rounding edges
        assert all(b >= a - 1e-3 * abs(a) for a, b in zip(found.likelihoods, found.likelihoods[1:]))


def test_language_model_without_training_rows(spark, empty, odd):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    docs = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    rows = hidden_markov.language_model(docs).frame.collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in rows] == [(0, 0, 0.0, 0.0)] * 3
    assert hidden_markov.language_model(empty).frame.count() == 0
    assert hidden_markov.language_model(odd).frame.count() == 2
