"""The pipeline's stages against brute force, and the registered queries against their SQL."""

import os
import re
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from tessera.llm import mixing, queries, toxicity
from tests.conftest import SF001
from tests.llm.test_small_cases import brute_components, brute_fingerprint, whole_ids, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with toxic documents, copies, benchmark passages, NULLs and repeated rows."""
    path = str(tmp_path_factory.mktemp("corpus"))
    item = words(30, 1)
    rows = [(i, " ".join(words(40, 500 + i)), "en", f"s{i % 3}", 1) for i in range(120)]
    rows += [(200 + i, " ".join(words(30, 900 + i) + ["idiot", "scum", "moron", "loser"]), "en", "s0", 1) for i in range(40)]
    rows += [(300 + i, rows[7][1], "en", "s1", 1) for i in range(4)]
    rows += [(400 + i, " ".join(words(10, 700 + i) + item), "en", "s2", 1) for i in range(3)]
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0), (None, "without an id", "en", "s1", 1),
             (None, "without an id", "en", "s1", 1), (9, " ".join(words(25, 77)), "en", "s2", 1), (9, rows[9][1], "en", "s2", 1)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(200 <= i < 240), 1) for i in [*range(0, 120, 2), *range(200, 240, 2)]]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(frame):
    return Counter((r.doc_id, r.text) for r in frame.collect())


def test_stages_take_effect_and_keep_columns(spark, folder):
    docs = queries.table(spark, folder, "documents")
    every = rows_of(docs)
    clean = STAGE["toxicity"](spark, docs, folder)
    assert clean.columns == docs.columns
    gone = every - rows_of(clean)
    assert set(gone) == {(i, t) for i, t in every if i is not None and 200 <= i < 240}
    found = toxicity.toxicity(docs, queries.table(spark, folder, "labels")).frame
    assert Counter(r.doc_id for r in found.filter("predicted = 1").collect()) == Counter(i for i, _ in gone.elements())

    single = STAGE["simhash_near_dedup"](spark, clean, folder)
    assert single.columns == docs.columns
    held = [(i, t) for (i, t) in rows_of(clean)]
    prints = {row: brute_fingerprint(row[1]) for row in held}
    root = brute_components(list(prints.values()), 3)
    groups = {}
    for row in held:
        groups.setdefault(root[prints[row]], []).append(row)
    kept = rows_of(single)
    assert all(n == 1 for n in kept.values())
    for members in groups.values():
        stay = [m for m in members if m in kept]
        ids = [m[0] for m in members if m[0] is not None]
        assert len(stay) == 1 and stay[0][0] == (min(ids) if ids else None)

    tested = STAGE["benchmark_decontamination"](spark, single, folder)
    assert rows_of(single) - rows_of(tested) == Counter({r: 1 for r in kept if r[0] is not None and 400 <= r[0] < 403})

    mixed = STAGE["mixing"](spark, tested, folder)
    assert mixed.columns == docs.columns
    plan = Counter()
    for r in mixing.mix(tested).collect():
        plan[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +plan

    rows = sorted(STAGE["token_ids"](spark, mixed, folder).collect(), key=lambda r: r.start)
    want = Counter((i, len(whole_ids(t))) for (i, t), n in rows_of(mixed).items() for _ in range(n))
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]
    assert [r.doc_id is not None for r in rows] == sorted(r.doc_id is not None for r in rows)


def test_run_equals_its_stages(spark, folder):
    docs = queries.table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=str) == sorted(map(tuple, docs.collect()), key=str)


def test_empty_corpus_goes_through(spark, folder, tmp_path):
    empty = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        queries.table(spark, folder, name).limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


CLASHING = ["near_id", "near_hash", "near_nameless", "mix_id", "mix_copies", "key", "row", "row_id", "row_hash", "text_hash", "id", "node",
            "hit_id", "own", "copy", "component_id", "predicted", "score", "copies", "size", "doc.id"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_extra_columns_come_through_unchanged(spark, folder, name):
    """Extra columns with the stages' own names keep their values and types, and change no decision."""
    docs = queries.table(spark, folder, "documents").coalesce(2)
    wide = docs.selectExpr("*", *[f"concat('{c} of ', coalesce(CAST(doc_id AS string), 'none')) AS `{c}`" for c in CLASHING])
    got, want = STAGE[name](spark, wide, folder), STAGE[name](spark, docs, folder)
    if name == "token_ids":
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        return
    assert got.columns == wide.columns and dict(got.dtypes)["near_id"] == "string"
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == rows_of(want)
    assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASHING)


def test_a_run_leaves_nothing_kept(spark, folder):
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    corpus_pipeline.run(spark, folder).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, name):
    got = queries.QUERIES[name](spark, SF001)
    con = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF001}/{table}.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]}) q").fetchall()
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_entry_and_library_work_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == 'corpus_pipeline' or name.startswith('tessera.llm'):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
assert entry.queries() and not any(k.startswith('op') or k == 'pipeline' for k in entry.queries())
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
