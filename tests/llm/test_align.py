"""Token alignment against a plain count of shared token ends."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from conftest_llm import ODD_TEXTS
from docflow.llm import align

A, B = public_tokenizers.path(align.A_TOKENIZER), public_tokenizers.path(align.B_TOKENIZER)


@pytest.fixture(scope="module")
def sides():
    return align.Sides(A, B)


def _plain(s, text):
    """Token ids and end offsets of both sides, or None where bytes differ."""
    if not text:
        return None
    whole = (" " + text).encode()
    a = s.a.encode(" " + text, add_special_tokens=False).ids
    b = s.b.encode(text)
    if b"".join(s.a_bytes[i] for i in a) != whole or b"".join(s.b_bytes[i] for i in b) != whole:
        return None
    ends = []
    for ids, table in ((a, s.a_bytes), (b, s.b_bytes)):
        at, out = 0, []
        for i in ids:
            at += len(table[i])
            out.append(at)
        ends.append(out)
    return a, b, ends[0], ends[1]


def _brute(s, rows):
    per, links = [], Counter()
    for doc_id, text in rows:
        found = _plain(s, text)
        if found is None:
            per.append((doc_id, None))
            continue
        a, b, ae, be = found
        cuts = sorted(set(ae) & set(be))
        groups, ai, bi = [], 0, 0
        for cut in cuts:
            ga, gb = [], []
            while ai < len(a) and ae[ai] <= cut:
                ga.append(a[ai])
                ai += 1
            while bi < len(b) and be[bi] <= cut:
                gb.append(b[bi])
                bi += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        pairs = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if ae[i] == be[j]]
        links.update(pairs)
        per.append((doc_id, (len(a), len(b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    best = Counter()
    for (x, y), c in links.items():
        best[y] = max(best[y], c)
    out = []
    for doc_id, found in per:
        if found is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_g, pairs, digest = found
        out.append(
            (
                doc_id,
                n_a,
                n_b,
                n_g,
                len(pairs),
                sum(links[p] == best[p[1]] for p in pairs),
                sum(links[p] for p in pairs),
                digest,
            )
        )
    return out


def test_alphabet_is_a_bijection():
    alphabet = align.byte_level_alphabet()
    assert sorted(alphabet.values()) == list(range(256))
    assert alphabet["!"] == 33 and alphabet["Ġ"] == 32


def test_round_trip_and_groups(sides):
    text = "Hello  world, </s> <|endoftext|> 漢字 🙂"
    a = np.array(sides.a.encode(" " + text, add_special_tokens=False).ids)
    b = np.array(sides.b.encode(text))
    n_a, n_b, n_groups, n_links, digest, pair_a, pair_b, n = align._document(sides, text, a, b)
    assert n_a == len(a) and n_b == len(b) and n_groups == n_links > 0 and len(digest) == 64
    assert n.sum() == n_links and set(pair_a) <= set(a) and set(pair_b) <= set(b)


def test_chunks_give_what_whole_texts_give(sides, monkeypatch):
    """Texts cut at single spaces, whose known chunks are also given up now and then."""
    rng = random.Random(3)
    bits = ["the", "mat.", "it's", "\n", "", "", "\t", " ", "漢字", "🙂", "\u2581x", "</s>", "<|endoftext|>", "x\x1cy", "\xa0", "3,5"]
    texts = [t or "" for t in ODD_TEXTS] + [" ".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(1500)]
    monkeypatch.setattr(align, "MAX_CHUNKS", 200)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for text, got in zip(part, align._documents(sides, part), strict=True):
            a, b = (np.array(sides.a.encode(" " + text, add_special_tokens=False).ids), np.array(sides.b.encode(text)))
            want = align._document(sides, text, a.astype(np.int64), b.astype(np.int64))
            assert got[:5] == want[:5]
            assert all(np.array_equal(x, y) for x, y in zip(got[5:], want[5:], strict=True))


def test_a_known_chunk_is_not_encoded_again(sides, monkeypatch):
    text = " ".join(f"word{k % 7}" for k in range(5000))
    seen = []
    plain = align._encoded
    monkeypatch.setattr(align, "_encoded", lambda s, texts: seen.extend(texts) or plain(s, texts))
    sides.chunks.clear()
    first, again = align._documents(sides, [text, text])
    assert first[4] == again[4] and len(seen) == 7


def test_against_brute_force(spark, sides):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(20, "the cat sat on the mat"), (21, "the cat sat on the mat"), (22, "The Cat's  mat, again.")]
    rows += [(23, "ｆｕｌｌ width"), (None, "no id here"), (20, "the cat sat on the mat")]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, row string, pairs int")
    got = sorted(align.align_documents(df.repartition(3), A, B).collect(), key=lambda r: (r[0] is None, r[0] or 0, r[7]))
    want = sorted(_brute(sides, rows), key=lambda r: (r[0] is None, r[0] or 0, r[7]))
    assert [tuple(r) for r in got] == want
    assert want[0][1:] == want[1][1:] == (0, 0, 0, 0, 0, 0, "")  # null and empty texts
    assert align.align_documents(df.limit(0), A, B).count() == 0
