"""The pipeline's stages against brute force, and the queries over whole tables."""

from __future__ import annotations

import random
import zlib

import duckdb
import numpy as np
import pytest

from compare import assert_same, connect
from conftest_llm import ODD_TEXTS, brute_components, word_list, word_set
from docflow.llm.queries import ORACLES, QUERIES

SOUNDS = {"aa": ["ka", "ta", "ra", "mo"], "bb": ["ou", "ei", "il", "un"]}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng = random.Random(12)
    items = [(k, speech(rng, "aa", 30)) for k in range(5)]
    rows = [(k, speech(rng, lang, rng.randint(5, 300)), lang) for k, lang in enumerate(["aa", "bb"] * 40)]
    rows += [(100 + k, rows[3][1], "bb") for k in range(4)]
    rows += [(200 + k, f"{rows[5][1]} {k}", "bb") for k in range(3)]
    rows += [(300 + k, speech(rng, "aa", 60) + " " + items[k][1], "aa") for k in range(5)]
    rows += [(400 + k, t, None) for k, t in enumerate(ODD_TEXTS[:4])] + [(None, speech(rng, "bb", 40), None), rows[8]]
    folder = tmp_path_factory.mktemp("small")
    docs = spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, items


def test_stages(spark, small):
    import corpus_pipeline

    folder, rows, items = small
    assert [n for n, _ in corpus_pipeline.STAGES] == ["languages", "near_duplicates", "decontamination", "packed"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        left[name] = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
    spoken = sorted(((i, t) for i, t, _ in rows if i is None or i < 400 or i == 403), key=str)
    assert left["languages"] == [r for r in spoken if r in left["languages"]]
    assert {r for r in spoken if r[0] != 403} <= set(left["languages"])
    sets = [(i, word_set(t, 5)) for i, t in left["languages"]]
    edges = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k]
             if None not in (i, j) and a and b and 100 * len(a & b) >= 80 * len(a | b)]
    names = brute_components({i for i, _ in sets if i is not None}, edges)
    want = sorted({(i, t) for i, t in left["languages"] if i is None or names[i] == i}, key=str)
    assert left["near_duplicates"] == want
    clean = [(i, t) for i, t in want
             if not any(b" ".join(word_list(x)) in b" ".join(word_list(t)) for _, x in items)]
    assert left["decontamination"] == clean and len(clean) == len(want) - 5


def test_run_packs_what_the_stages_keep(spark, small):
    import corpus_pipeline

    folder, rows, _ = small
    pieces = corpus_pipeline.run(spark, folder).collect()
    ids = {p.doc_id for p in pieces}
    assert {0, 3, None} <= ids and not ids & {100, 103, 200, 300, 304, 400, 401, 402}
    assert sorted({p.sequence_id for p in pieces}) == list(range(1 + max(p.sequence_id for p in pieces)))


def test_all_thirteen_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys()


def test_search_reaches_the_recall(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.01", "sf0.1")
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = QUERIES["op10_neighbours"](spark, sf_dir).collect()
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        score = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        best = [i for i in ids[np.lexsort((ids, score))] if i != q][:10]
        found = [r.vec_id for r in got if r.query_id == q]
        hits, total = hits + len(set(best) & set(found)), total + 10
    assert hits / total >= 0.9


def test_held_out_accuracy_and_likelihood(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, lang FROM '{sf_dir}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in QUERIES["op9_language"](spark, sf_dir).collect()}
    held = [(i, lang) for i, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)
    assert np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.98
    assert sum(r.rejected for r in got.values()) <= 1
    scored = [r for r in QUERIES["op6_suffix_tree"](spark, sf_dir).collect() if r.held_out]
    assert sum(r.score for r in scored) > sum(r.base_score for r in scored)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) > 0


def test_near_duplicates_judges_rows_not_ids(spark):
    import corpus_pipeline

    rng = random.Random(4)
    a, b = speech(rng, "aa", 80), speech(rng, "bb", 80)
    rows = [(1, a, "x", 0), (2, a + " extra", "y", 1), (2, b, "z", 2), (2, b, "z", 2), (None, a, "w", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, _row long").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[2], rows[4]], key=str)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").count() == 0


def test_near_duplicates_neither_writes_nor_sorts_texts(spark, monkeypatch):
    """Only ids, hashes and sets are written; rows stay where they were read, in their order."""
    import corpus_pipeline
    from docflow.llm import graph, neardup

    rng = random.Random(6)
    rows = [(k % 40, speech(rng, "aa", 60) + f" {k}", "x") for k in range(60)]
    rows += [(100 + k, f"{rows[k][1]} more", "y") for k in range(0, 60, 7)] + [rows[3], rows[3], (200, rows[5][1], "z")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").coalesce(1)
    tables = []
    for module in (corpus_pipeline, neardup, graph):
        keep = module.written if hasattr(module, "written") else None
        if keep:
            monkeypatch.setattr(module, "written", lambda df, *a, f=keep: tables.append(df.columns) or f(df, *a))
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert len(tables) > 5 and not [t for t in tables if "text" in t]
    sets = [word_set(t, 5) for _, t, _ in rows]
    edges = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 100 * len(a & b) >= 80 * len(a | b)]
    names = brute_components(range(len(rows)), edges)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[names[k]] = min(i, least.get(names[k], i))
    assert sorted(r[0] for r in kept) == sorted(least.values())
    assert set(kept) <= set(rows) and len(set(kept)) == len(kept)
    again = [k for k in kept if rows.count(k) > 1]
    rest = [k for k in kept if k not in again]
    assert rest == [r for r in rows if r in rest] and again == [rows[rows.index(again[0])]]


def test_stages_pass_few_documents_at_once(spark, small):
    import corpus_pipeline

    folder, _, _ = small
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(conf)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(conf, "10000")
            stage(spark, docs, folder)
            assert spark.conf.get(conf) == "512"
        spark.conf.set(conf, "100")
        stage(spark, docs, folder)
        assert spark.conf.get(conf) == "100"
    finally:
        spark.conf.set(conf, old)
