"""Decontamination, language identification and the suffix tree."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest_llm import ODD_TEXTS, word_list, words
from docflow.llm import decontaminate as dc
from docflow.llm import langid, suffixtree


def plain_alignment(a, b):
    now, best = [0] * (len(b) + 1), 0
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, now[j] + (2 if x == y else -1), now[j + 1] - 1, row[j] - 1))
        now, best = row, max(best, *row)
    return best


def test_alignment():
    rng = random.Random(1)
    pairs = [
        ([rng.randint(1, 6) for _ in range(rng.randint(1, 30))], [rng.randint(1, 6) for _ in range(rng.randint(1, 50))])
        for _ in range(60)
    ]
    got = dc.smith_waterman([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    assert got.tolist() == [plain_alignment(a, b) for a, b in pairs]


def test_windows_cover_hits_and_stay_short():
    for low, high in dc.windows([(k, 0) for k in range(0, 5000, 3)], 20, 5000):
        assert high - low <= 4 * 20 + 2 * 7
    assert list(dc.windows([(50, 10)], 20, 1000)) == [(33, 67)]


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(9)
    rows = [(k, words(rng, 30 + k)) for k in range(8)] + [(50, None), (51, ""), (52, "two words"), (0, "again " * 12)]
    return rows, spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, doc_id long")


def planted(items, rng):
    """Copies that are exact, edited, shortened and lengthened, and documents without any."""
    texts = {i: t.split() for i, t in items if i < 8 and t and not t.startswith("again")}
    rows, want = [], set()
    for k in range(40):
        item = k % 8
        copy = list(texts[item])
        for _ in range(k // 8 * 2):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice([[], ["new"], [copy[at], "more"]])
        rows.append((k, words(rng, 50) + " " + " ".join(copy).upper() + "\n" + words(rng, 200)))
        want.add((k, item))
    rows += [(100 + k, words(rng, 300)) for k in range(30)]
    return rows, want


def test_planted_copies_are_found(spark, items):
    rows, frame = items
    documents, want = planted(rows, random.Random(3))
    documents += [(200 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, documents[0][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in documents], "doc_id long, text string, contaminated string")
    got = dc.benchmark_matches(df, frame).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want | {(None, 0)}
    by_pair = {(r.doc_id, r.item_id): r for r in got}
    whole = dict(documents)
    for (doc, item), r in by_pair.items():
        text = next(t.split() for i, t in rows if i == item)
        part = [w.decode() for w in word_list(whole[doc])][r.first_word : r.last_word]
        assert math.isclose(r.score, plain_alignment([w.lower() for w in text], part) / (2 * len(text)))
    flagged = dc.flag_contaminated(df, frame)
    assert flagged.columns == ["doc_id", "text", "contaminated", "_contaminated"]
    assert sorted(str(r.doc_id) for r in flagged.where("_contaminated").collect()) == sorted(
        str(i) for i in {i for i, _ in want} | {None}
    )
    assert flagged.count() == len(documents)


def test_items_in_blocks(spark, items, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_WORDS", 60)
    rows, frame = items
    documents, want = planted(rows, random.Random(3))
    got = dc.benchmark_matches(spark.createDataFrame(documents, "doc_id long, text string"), frame)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_common_items_are_found_too(spark, items):
    """An item that a third of all documents hold has no rare n-grams, and seeds all the same."""
    rows, frame = items
    rng = random.Random(6)
    documents = [(k, words(rng, 40) + (" " + rows[2][1] if k % 3 == 0 else "")) for k in range(90)]
    got = dc.benchmark_matches(spark.createDataFrame(documents, "doc_id long, text string"), frame)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(k, 2) for k in range(0, 90, 3)}


def test_no_items_or_documents(spark, items, docs, nothing):
    assert dc.benchmark_matches(nothing, items[1]).count() == 0
    assert dc.benchmark_matches(docs, items[1].limit(0)).count() == 0
    assert dc.flag_contaminated(docs, items[1].limit(0)).where("_contaminated").count() == 0


# --- languages ---------------------------------------------------------------

SOUNDS = {"aa": ["ka", "ta", "ra"], "bb": ["ou", "ei", "üö"], "cc": ["str", "schn", "pf"]}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(8)
    rows = [(k, speech(rng, lang, rng.randint(5, 80)), lang) for k, lang in enumerate(list(SOUNDS) * 60)]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !?", "cc"), (1003, "kata", None), (1004, "x", "und")]
    return rows, spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, score string")


def test_languages_are_told_apart(spark, spoken):
    rows, df = spoken
    model = langid.fit(df.where("doc_id % 4 != 0"))
    assert sorted(set(model.names)) == list(SOUNDS)
    got = langid.identify(df, model)
    assert got.columns == ["doc_id", "text", "lang", "score", "lang_pred", "_score", "rejected"]
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows)
    held = [i for i, _, _ in rows[:180] if i % 4 == 0]
    assert np.mean([found[i].lang_pred == rows[i][2] for i in held]) > 0.98
    assert not any(found[i].rejected for i, _, _ in rows[:180])
    for i in (1000, 1001, 1002):
        assert (found[i].lang_pred, found[i]._score, found[i].rejected) == ("und", 0.0, True)
    assert all(0 <= r._score <= 1 for r in found.values())
    far = langid.identify(spark.createDataFrame([("漢字仮名交じり文",)], "text string"), model).first()
    assert far.rejected and far.lang_pred in SOUNDS


def test_languages_that_were_not_taught_are_rejected(spark, sf_dir):
    """English is left in: a few of its texts are labelled as other languages, which teaches it all the same."""
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.1')}/documents.parquet")
    docs = docs.where("doc_id % 2 = 0 AND lang IS NOT NULL").select("doc_id", "text", "lang")
    for out in ("de", "es", "fr"):
        model = langid.fit(docs.where(F.col("lang") != out).where("doc_id % 4 = 0"))
        judged = langid.identify(docs.where("doc_id % 4 = 2 AND length(text) > 200"), model)
        share = dict(judged.groupBy(F.col("lang") == out).agg(F.avg(F.col("rejected").cast("int"))).collect())
        assert share[True] > 0.9 and share[False] < 0.01


def test_language_profiles_of_short_texts_take_bounded_memory():
    """What is held at once follows neither the rows of a batch nor how short its texts are."""
    import tracemalloc

    texts = pa.array(["ab cd", None, "", "ef"] * 2500)
    tracemalloc.start()
    at = 0
    for i, j, counts in langid.profiles(texts):
        assert i == at and len(counts) == j - i
        at = j
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert at == len(texts) and peak < 32 << 20


def test_long_texts_are_counted_whole():
    text = "katara " * 60_000 + "schnpf"
    counts = [c for _, _, c in langid.profiles(pa.array([text]))]
    whole = langid.profile(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    assert len(counts) == 1 and abs(counts[0].sum() / whole.sum() - 1) < 1e-4


def test_no_labels(docs, nothing, spark):
    model = langid.fit(nothing.withColumn("lang", F.lit("aa")))
    rows = langid.identify(docs, model).collect()
    assert {(r.lang_pred, r.rejected) for r in rows} == {("und", True)}
    assert langid.identify(nothing, model).count() == 0


# --- suffix tree -------------------------------------------------------------


def test_scores(docs, corpus):
    learn = F.pmod(F.col("doc_id"), F.lit(5)) != 0
    got = suffixtree.score_texts(docs, learn).collect()
    assert len(got) == len(corpus)
    tokens = [(i, [*word_list(t), b"\n"]) for i, t in corpus]
    counts = Counter(w for i, ws in tokens if i is not None and i % 5 for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, ws in tokens:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws)
        want[i, i is not None and i % 5 != 0, len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 5)] += 1
    seen = Counter((r.doc_id, r.learned, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got)
    assert seen == want
    by_text = {}
    for (i, t), r in zip(sorted(corpus, key=str), sorted(got, key=lambda r: str((r.doc_id, dict(corpus)[r.doc_id])))):
        assert r.score < 0
        assert by_text.setdefault((t or "").lower().split().__str__(), r.score) == pytest.approx(r.score)


def test_rare_words_are_joined(docs, corpus, monkeypatch):
    learn = F.lit(True)
    key = lambda r: (str(r.doc_id), r.n_tokens)
    all_sent = sorted(suffixtree.score_texts(docs, learn).collect(), key=key)
    monkeypatch.setattr(suffixtree, "FREQUENT", 3)
    some_sent = sorted(suffixtree.score_texts(docs, learn).collect(), key=key)
    for a, b in zip(all_sent, some_sent, strict=True):
        assert (a.n_known, a.n_tokens) == (b.n_known, b.n_tokens)
        assert a.base_score == pytest.approx(b.base_score)


def test_a_tree_in_blocks_is_the_whole_tree(spark, docs, monkeypatch):
    """However little a block holds, no state is left out and no score changes."""
    key = lambda r: (str(r.doc_id), r.n_tokens, r.score)
    whole = sorted(suffixtree.score_texts(docs, F.lit(True)).collect(), key=key)
    monkeypatch.setattr(suffixtree, "ENTRIES", 700)
    monkeypatch.setattr(suffixtree, "CHUNK", 1 << 14)
    cut = sorted(suffixtree.score_texts(docs, F.lit(True)).collect(), key=key)
    for a, b in zip(whole, cut, strict=True):
        assert (a.doc_id, a.n_known, a.score) == (b.doc_id, b.n_known, pytest.approx(b.score))


def test_states_are_distributions(spark):
    """The chances of all symbols after any context add up to one."""
    rng = random.Random(11)
    texts = [words(rng, 60) for _ in range(40)]
    keys = np.concatenate([k for _, _, k, _, _, _ in suffixtree.spelled(pa.array(texts))])
    kinds, n = np.unique(keys, return_counts=True)
    grams = spark.createDataFrame(list(zip(kinds.view(np.int64).tolist(), n.tolist(), strict=True)), "key long, n long")
    tree = suffixtree.grow_tree(grams)
    assert sum(len(level[0]) for level in tree[1:]) > 10
    symbols = np.array([s for s in range(256) if s not in (9, 11, 12, 13)], np.uint64)
    assert len(symbols) == suffixtree.SYMBOLS
    for context in [*rng.sample(kinds.tolist(), 30), 0x7A7A7A7A7A7A7A]:
        base = (np.uint64(context) << np.uint64(8)) & np.uint64((1 << 56) - 1)
        assert np.sum(10 ** suffixtree.gram_log10(tree, base | symbols)) == pytest.approx(1)


def test_spelling_does_not_depend_on_slices(monkeypatch):
    texts = ["One two", None, "", "w " * 3000 + "end", "y" * 3000 + " z"]
    whole = np.concatenate([k for _, _, k, _, _, _ in suffixtree.spelled(pa.array(texts))])
    monkeypatch.setattr(suffixtree, "SLICE", 64)
    cut = np.concatenate([k for _, _, k, _, _, _ in suffixtree.spelled(pa.array(texts))])
    assert np.array_equal(whole, cut)


def test_nothing_to_learn_or_score(docs, corpus, nothing):
    got = suffixtree.score_texts(docs, F.lit(False)).collect()
    assert len(got) == len(corpus) and {r.n_known for r in got} == {0} and {r.train_tokens for r in got} == {0}
    assert suffixtree.score_texts(nothing, F.lit(True)).count() == 0




def test_grams_of_one_suffix_look_it_up_once(monkeypatch):
    rng = random.Random(12)
    (found,) = suffixtree.spelled(pa.array([words(rng, 400)]))
    keys = np.unique(found[2])
    none = (np.zeros(0, np.uint64), np.zeros(0)) * 2
    asked = []
    plain = suffixtree.look_up
    monkeypatch.setattr(suffixtree, "look_up", lambda k, v, wanted, missing: asked.append(len(wanted)) or plain(k, v, wanted, missing))
    got = suffixtree.gram_log10([none] * (suffixtree.DEPTH + 1), keys[::-1])
    assert np.allclose(got, -np.log10(suffixtree.SYMBOLS)) and len(got) == len(keys)
    for length in range(suffixtree.DEPTH + 1):
        suffixes = np.unique(keys & np.uint64((1 << 8 * (length + 1)) - 1))
        assert set(asked[2 * length : 2 * length + 2]) == {len(suffixes)}
