"""Hard negatives: Strassen against plain products, the operator against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from docflow.llm import hardneg


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 64, 33), (40, 7, 129), (64, 64, 64), (3, 100, 2)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a = rng.integers(-300, 300, (m, k))
    b = rng.integers(-300, 300, (k, n))
    assert np.array_equal(hardneg.strassen(a, b, 3), a @ b)


def test_large_values_stay_exact():
    big = np.array([[3.0e12, -1.0], [7.0, 2.5e11]])
    rows = np.array([[4.0e12, 1.0], [1.0, -9.0e12]])
    got = hardneg.scores(big, rows)
    want = [[int(x) * int(y) + int(u) * int(v) for (y, v) in rows] for (x, u) in big]
    assert [[int(v) for v in r] for r in got] == want
    assert hardneg.as_long(np.array([1 << 70, -(1 << 70), 5], dtype=object)).tolist() == [
        (1 << 63) - 1,
        -(1 << 63),
        5,
    ]


def _rows():
    rng = random.Random(11)
    rows = []
    for vid in range(0, 420):
        vec = [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(8)]
        rows.append((vid, vec, rng.randint(0, 3)))
    rows += [(1000, None, 1), (1001, [0.1] * 7 + [float("nan")], 1), (1002, [0.1] * 7 + [None], 1)]
    rows += [(1003, [float("inf")] + [0.0] * 7, 2), (1004, [0.3] * 8, None), (None, [0.3] * 8, 1)]
    rows += [(1100, [0.2] * 3, 1), (1200, [0.2] * 3, 2), (1201, [0.1] * 3, 1), (1300, [], 4), (1301, [], 5)]
    rows += [rows[5], rows[100], rows[200]]  # repeated rows, anchor 100 and 200 among them
    rows += [(2000 + k, [0.25] * 8, 1) for k in range(30)]  # ties
    return rows


def _brute(rows):
    kept = []
    for vid, vec, label in rows:
        if vid is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vid % 7 == 0 else label
        q = [math.floor(256 * float(np.float32(x))) for x in vec]
        kept.append((vid, label, q))
    out = []
    for aid, alabel, aq in kept:
        if aid % 100:
            continue
        scored = [
            (sum(x * y for x, y in zip(aq, q, strict=True)), vid, label)
            for vid, label, q in kept
            if vid != aid and len(q) == len(aq)
        ]
        scored.sort(key=lambda t: (-t[0], t[1]))
        for ps, pid, _ in [s for s in scored if s[2] == alabel][:5]:
            negs = [s for s in scored if s[2] != alabel and 30 * ps <= 100 * s[0] <= 90 * ps][:10]
            out += [(aid, pid, r + 1, nid, ps, ns) for r, (ns, nid, _) in enumerate(negs)]
    return sorted(out)


def test_against_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(
        [(v, vec, lab, "x", 1) for v, vec, lab in rows],
        "vec_id long, embedding array<float>, label int, slot string, score long",
    ).repartition(7)
    got = sorted(tuple(r) for r in hardneg.hard_negatives(df).collect())
    want = _brute(rows)
    assert got == want
    assert {r[0] for r in want} >= {0, 100, 200, 300, 400}


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(hardneg, "BLOCK_BYTES", 8 * 8 * 2)
    monkeypatch.setattr(hardneg, "SCORE_BYTES", 8 * 2 * 3)
    assert sorted(tuple(r) for r in hardneg.hard_negatives(df).collect()) == _brute(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hardneg.hard_negatives(df).count() == 0
    only_bad = spark.createDataFrame([(100, None, 1), (200, [1.0], None)], "vec_id long, embedding array<float>, label int")
    assert hardneg.hard_negatives(only_bad).count() == 0
