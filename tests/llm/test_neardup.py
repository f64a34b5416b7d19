"""Near-duplicates and components against brute force over all pairs."""

from __future__ import annotations

import random


import numpy as np
import pytest

from docflow.llm import graph, neardup, words
from conftest_llm import brute_components, word_set


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)]
    edges += [(1000, 1000 + k) for k in range(1, 400)] + [(k, k + 1) for k in range(5000, 5060)]
    edges += [(7, 7), (None, 3), edges[0]]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [e for e in edges if None not in e and e[0] != e[1]]
    want = brute_components({n for e in real for n in e}, real)
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_slices():
    import pyarrow as pa

    texts = ["One two", None, "", " x ", "long " * 5000 + "end", "y" * 3000 + " z"]
    whole = [h for _, _, h, _ in words.hashed(pa.array(texts), 1 << 20)]
    cut = [h for _, _, h, _ in words.hashed(pa.array(texts), 64)]
    assert np.array_equal(np.concatenate(whole), np.concatenate(cut))
    assert sum(c.sum() for _, _, _, c in words.hashed(pa.array(texts), 64)) == 2 + 1 + 5001 + 2


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, corpus, width, percent):
    got = neardup.near_duplicates(docs, width, percent).collect()
    sets = [(i, word_set(t, width)) for i, t in corpus]
    edges = [
        (i, j)
        for k, (i, a) in enumerate(sets)
        for j, b in sets[:k]
        if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    want = brute_components({i for i, _ in sets if i is not None}, edges)
    assert len(got) == len(corpus)
    size = {i: len(s) for i, s in sets}
    for r in got:
        assert r.n_shingles == size[r.doc_id]
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or want[r.doc_id] == r.doc_id)
    assert want[105] == 100 and want[203] == 100


def test_further_centres(spark):
    """A chain: each text is similar to the next only, so one star does not join a bucket."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(12):
        for _ in range(16):
            base[rng.randrange(400)] = f"e{rng.random()}"
        rows.append((k, " ".join(base)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 70).collect()
    sets = [(i, word_set(t, 3)) for i, t in rows]
    edges = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if 100 * len(a & b) >= 70 * len(a | b)]
    assert {r.doc_id: r.component_id for r in got} == brute_components(set(range(12)), edges)


def test_no_documents(nothing):
    assert neardup.near_duplicates(nothing).count() == 0


def test_signatures_of_equal_sets_are_equal():
    values = np.sort(words.mix(np.arange(1, 4, dtype=np.uint64)))
    made = neardup.signatures([values, values, values[:1]], 140)
    assert np.array_equal(made[0], made[1])
    assert set(made[2].tolist()) == {int(values[0])} and (made != 0).all()


def test_many_near_copies_stay_apart(spark, monkeypatch):
    """Copies edited too much for their model, but for some pairs of them: the bucket's pairs are not all made."""
    rng = random.Random(7)
    base = [f"w{k}" for k in range(60)]
    rows = [(0, " ".join(base))]
    for k in range(1, 150):
        words_of = list(base)
        for n in range(rng.choice([1, 1, 3, 4, 5])):
            words_of[rng.randrange(60)] = f"e{k}.{n}"
        rows.append((k, " ".join(words_of)))
        if k % 10 == 0:
            words_of[rng.randrange(60)] = f"f{k}"
            rows.append((1000 - k, " ".join(words_of)))
    # Rows that repeat an id are judged by their own text each.
    rows.append((rows[2][0], "another text of this very id that is like none"))
    made = []
    confirmed = neardup._confirmed
    monkeypatch.setattr(neardup, "_confirmed", lambda p, *a: made.append(p.count()) or confirmed(p, *a))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    sets = [(i, word_set(t, 3)) for i, t in rows]
    edges = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if 100 * len(a & b) >= 85 * len(a | b)]
    want = brute_components({i for i, _ in rows}, edges)
    assert {r.doc_id: r.component_id for r in got if r.n_shingles > 9} == want
    assert len(set(want.values())) > 20
    assert sum(made) < 6 * len(rows)


def test_files_do_not_follow_the_partitions_of_shuffles(spark, monkeypatch):
    """With 211 partitions that are not coalesced, written tables still have some files for each core at most."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(80):
        edited = list(base)
        for n in range(rng.choice([1, 3, 5])):
            edited[rng.randrange(60)] = f"e{k}.{n}"
        rows.append((k, " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    files = []

    def watched(write):
        def run(df, *a):
            out = write(df, *a)
            files.append(len(out.inputFiles()))
            return out

        return run

    monkeypatch.setattr(neardup, "written", watched(neardup.written))
    monkeypatch.setattr(graph, "written", watched(graph.written))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "211")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, 85).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    sets = [(i, word_set(t, 3)) for i, t in rows]
    edges = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if 100 * len(a & b) >= 85 * len(a | b)]
    assert got == brute_components(set(range(80)), edges)
    assert len(files) > 10 and max(files) <= 8 * 8
