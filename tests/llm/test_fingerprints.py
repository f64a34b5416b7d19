"""Fingerprints: agreement rate against generalised Jaccard, edits against a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from conftest_llm import ODD_TEXTS, word_list, words
from docflow.llm import fingerprints as fp


def _bag(text, width=5):
    w = word_list(text)
    if not w:
        return Counter()
    if len(w) < width:
        return Counter([tuple(w)])
    return Counter(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def _jaccard(x, y):
    keys = set(x) | set(y)
    if not keys:
        return 1.0
    return sum(min(x[k], y[k]) for k in keys) / sum(max(x[k], y[k]) for k in keys)


def test_agreement_follows_generalised_jaccard():
    rng = random.Random(3)
    errors = []
    for _ in range(60):
        base = words(rng, rng.randint(200, 600)).split()
        other = list(base)
        for _ in range(rng.randint(0, len(base) // 3)):
            other[rng.randrange(len(other))] = "zz" + str(rng.random())
        other += base[: rng.randint(0, 200)]
        a, b = " ".join(base), " ".join(other)
        got = fp.likeness(*fp.fingerprints(pa.array([a, b])))
        errors.append(got - _jaccard(_bag(a), _bag(b)))
    assert abs(np.mean(errors)) < 0.03 and np.sqrt(np.mean(np.square(errors))) < 0.1


def test_equal_texts_and_empty_sets():
    texts = ["Same text here", "same TEXT here", "", None, "  \n", "one two three four five six"]
    got = fp.fingerprints(pa.array(texts))
    assert got[0] == got[1] and len(got[0]) == 8 * fp.SAMPLES
    assert got[2] == got[3] == got[4] == ""
    assert fp.likeness(got[2], got[3]) == 1.0 and fp.likeness(got[0], got[2]) == 0.0
    long = "word " * 30_000
    assert len(fp.fingerprints(pa.array([long]))[0]) == 8 * fp.SAMPLES


def _brute(spark, rows):
    hashes = [
        r[0] for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("xxhash64(t)").collect()
    ]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), hashes[i], i))
    out = []
    for place, i in enumerate(order):
        doc_id, text = rows[i]
        text = text or ""
        nxt = rows[order[(place + 1) % len(order)]][1] or ""
        n = len(text)
        m = n // 3
        edited = text[: n - m] + nxt[:m]
        mine, theirs, next_print = fp.fingerprints(pa.array([text, edited, nxt]))
        out.append(
            (
                doc_id,
                n,
                hashlib.sha256(edited.encode()).hexdigest(),
                mine,
                theirs,
                fp.likeness(mine, theirs),
                fp.likeness(mine, next_print),
            )
        )
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def test_against_plain_version(spark, monkeypatch, tmp_path):
    rng = random.Random(8)
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(50 + k, words(rng, rng.randint(0, 300))) for k in range(30)]
    rows += [(60, rows[-1][1]), (None, "no id"), (None, None), (3, "One")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, rank int, seq string")
    # A table: read again, it gives the same rows in the same places, as the operator needs.
    df.repartition(4).write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    got = fp.fingerprint_documents(df).collect()
    monkeypatch.setattr(fp, "PART_ROWS", 4)
    small_parts = fp.fingerprint_documents(df).collect()
    assert sorted(map(tuple, small_parts), key=str) == sorted(map(tuple, got), key=str)
    got = sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert got == _brute(spark, rows)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    row = fp.fingerprint_documents(one).collect()[0]
    # "abc def" becomes "abc d" + "ab": another word set.
    assert row.near_edited == 0.0 and row.near_next == 1.0 and row.n_chars == 7
    assert fp.fingerprint_documents(one.limit(0)).count() == 0
