"""Benchmark decontamination by rare n-gram seeds and Smith-Waterman (dealt operator 2).

A first pass over the corpus counts in how many documents each n-gram of the
test items occurs. Of every ``RUN`` consecutive n-grams of an item the rarest
is a seed, so each item has seeds however common it is, and any
``RUN + SEED - 1`` words copied without an edit hold one. A second pass finds
seeds in the documents and aligns the words around them with the item; edits,
insertions and deletions lower the score instead of hiding the copy.

Test items are worked off in blocks of bounded size, each sent to all tasks
against all documents. Documents never move.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import fresh, ship, written
from docflow.llm.words import hashed, mix

SEED = 3
RUN = 4
BLOCK_WORDS = 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
# Words of a perfect copy that an alignment must be worth: half of the item, LONG
# at most, and not below SHORT (or the whole item, if that is shorter).
SHARE, LONG, SHORT = 0.5, 20, 8
ALIGN = 64


def grams(hashes: np.ndarray) -> np.ndarray:
    """A hash for each SEED consecutive words."""
    rolled = np.zeros(max(0, len(hashes) - SEED + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SEED):
            rolled = mix(rolled + hashes[k : k + len(rolled)] + np.uint64(k + 1))
    return rolled


def needed_words(size: int) -> float:
    return max(min(SHARE * size, LONG), min(size, SHORT))


def smith_waterman(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each pair of word sequences, all pairs side by side."""
    rows, width = max(map(len, left)), max(map(len, right))
    a = np.zeros((len(left), rows), np.uint64)
    b = np.zeros((len(right), width), np.uint64)
    in_a, in_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    for k, (x, y) in enumerate(zip(left, right, strict=True)):
        a[k, : len(x)], in_a[k, : len(x)] = x, True
        b[k, : len(y)], in_b[k, : len(y)] = y, True
    step = -GAP * np.arange(1, width + 1, dtype=np.int32)
    now = np.zeros((len(left), width + 1), np.int32)
    best = np.zeros(len(left), np.int32)
    for i in range(rows):
        same = (b == a[:, i : i + 1]) & in_b & in_a[:, i : i + 1]
        score = now[:, :-1] + np.where(same, MATCH, MISMATCH).astype(np.int32)
        score = np.maximum(np.maximum(score, now[:, 1:] + GAP), 0)
        # A run of gaps in the item: best earlier score less the way from there.
        now[:, 1:] = np.maximum.accumulate(score + step, axis=1) - step
        best = np.maximum(best, now.max(axis=1))
    return best


def windows(hits: list[tuple[int, int]], size: int, length: int) -> Iterator[tuple[int, int]]:
    """Word ranges around hits (place in the document, place in the item), none much longer than the item."""
    slack = size // 4 + 2
    merged: list[list[int]] = []
    for first in sorted(p - q for p, q in hits):
        low, high = max(0, first - slack), min(length, first + size + slack)
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    for low, high in merged:
        at = low
        while high - at > 4 * size + 2 * slack:
            yield at, at + 4 * size
            at += 2 * size
        yield at, high


class Items:
    """A block of test items: word hashes of each and where their n-grams are."""

    def __init__(self, ids: list[int], words: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.grams = np.unique(np.concatenate([grams(w) for w in words] or [np.zeros(0, np.uint64)]))

    def seeds(self, counts: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """Sorted seed hashes and for each the (item, place) it stands for."""
        where: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, words in enumerate(self.words):
            own = grams(words)
            rarity = counts[np.searchsorted(self.grams, own)]
            chosen = set()
            for at in range(max(1, len(own) - RUN + 1) if len(own) else 0):
                chosen.add(at + int(np.argmin(rarity[at : at + RUN])))
            for place in sorted(chosen):
                where[int(own[place])].append((item, place))
        keys = sorted(where)
        return np.array(keys, np.uint64), [where[k] for k in keys]


def found_in(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` that are in sorted ``keys``, and their place there."""
    if not len(keys) or not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(keys, values).clip(max=len(keys) - 1)
    places = np.flatnonzero(keys[at] == values)
    return places, at[places]


def _gram_places(hashes: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
    """(document, its words, places in it, places in keys) of documents with n-grams in ``keys``."""
    first = np.concatenate(([0], np.cumsum(counts)))
    places, at = found_in(keys, grams(hashes))
    owner = np.searchsorted(first, places, "right") - 1
    inside = places + SEED <= first[owner + 1] if len(places) else np.zeros(0, bool)
    places, at, owner = places[inside], at[inside], owner[inside]
    edges = np.flatnonzero(np.diff(owner)) + 1
    for some in np.split(np.arange(len(owner)), edges) if len(owner) else []:
        doc = owner[some[0]]
        yield doc, hashes[first[doc] : first[doc + 1]], places[some] - first[doc], at[some]


def _count(keys_of: Callable[[], np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = keys_of()
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, _, hashes, counts in hashed(batch.column(0)):
                for _, _, _, at in _gram_places(hashes, counts, keys):
                    total[np.unique(at)] += 1
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    return run


def _matches(items: Items, keys: np.ndarray, where: list, column: pa.Array) -> Iterator[tuple]:
    """(row, item, score, first word, last word) of each document and item that match."""
    for i, _, hashes, counts in hashed(column):
        todo = []
        for doc, words, places, at in _gram_places(hashes, counts, keys):
            hits = defaultdict(list)
            for place, key in zip(places.tolist(), at.tolist(), strict=True):
                for item, own in where[key]:
                    hits[item].append((place, own))
            for item, pairs in hits.items():
                size = len(items.words[item])
                todo += [(i + doc, item, words, low, high) for low, high in windows(pairs, size, len(words))]
        # Like sizes together, so that little is padded.
        todo.sort(key=lambda t: (t[4] - t[3], len(items.words[t[1]])))
        best: dict[tuple[int, int], tuple] = {}
        for k in range(0, len(todo), ALIGN):
            some = todo[k : k + ALIGN]
            scores = smith_waterman([items.words[t[1]] for t in some], [t[2][t[3] : t[4]] for t in some])
            for (row, item, _, low, high), score in zip(some, scores.tolist(), strict=True):
                size = len(items.words[item])
                if score >= MATCH * needed_words(size):
                    found = (score / (MATCH * size), -low, high)
                    best[row, item] = max(best.get((row, item), found), found)
        for (row, item), (score, low, high) in sorted(best.items()):
            yield int(row), item, score, -low, high


def _blocks(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, doc_text: str) -> Iterator[tuple]:
    """Broadcast (ids, words, seed keys, seed places) of one bounded block of items after the other."""
    spark = docs.sparkSession

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, counts in hashed(batch.column(1)):
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists], ["id", "words"])

    slim = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sized = written(slim.mapInArrow(words, "id long, words array<long>"), "items")
    total = sized.agg(F.sum(F.size("words"))).first()[0] or 0
    n_blocks = -(-total // BLOCK_WORDS)
    for block in range(n_blocks):
        # BLOCK_WORDS numbers or so: a bounded block of the query set.
        rows = sized.where(F.pmod(F.xxhash64("id", "words"), F.lit(n_blocks)) == block).distinct().collect()
        rows = sorted(((r["id"], r["words"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        kept = [np.array(w, np.int64).view(np.uint64) for _, w in rows]
        known = Items([r[0] for r in rows], kept)
        shared = spark.sparkContext.broadcast(known.grams)
        counted = docs.select(doc_text).mapInArrow(_count(lambda s=shared: s.value), "gram long, n long")
        counts = np.zeros(len(known.grams), np.int64)
        for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
            counts[row["gram"]] = row["n"]
        shared.destroy()
        yield spark.sparkContext.broadcast((known.ids, known.words, *known.seeds(counts)))


MATCHES = "doc_id long, item_id long, score double, first_word long, last_word long"


def benchmark_matches(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row for each document and test item that match.

    ``score`` is the alignment's worth as a share of a perfect copy;
    ``first_word`` and ``last_word`` bound the words that were aligned. Words
    are runs without white space, A-Z in lower case. Documents or items that
    are null, or have fewer words than a seed, match nothing. Null ids stay
    null; equal rows of ``df`` give equal rows, equal rows of ``items`` count
    once. Other columns are ignored; an empty table gives no rows.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = df.sparkSession.createDataFrame([], MATCHES)
    names = [f.split()[0] for f in MATCHES.split(", ")]
    for shared in _blocks(docs, items, item_id, item_text, "text"):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, words, keys, where = shared.value
            known = Items(ids, words)
            for batch in batches:
                found = list(_matches(known, keys, where, batch.column(1)))
                if found:
                    rows, item, score, low, high = zip(*found, strict=True)
                    arrays = [
                        batch.column(0).take(pa.array(rows)),
                        pa.array([ids[k] for k in item], pa.int64()),
                        *map(pa.array, (score, low, high)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names)

        out = out.unionAll(docs.mapInArrow(run, MATCHES))
    return out


def flag_contaminated(
    df: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``df`` with a boolean column ``contaminated`` for rows that match any test item.

    Rows are judged by themselves, whatever their ids; the rules are those of
    :func:`benchmark_matches`. The column gets underscores if the name is taken.
    """
    (flag,) = fresh(df, "contaminated")
    out = df.withColumn(flag, F.lit(False))
    place = len(df.columns)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    for shared in _blocks(df, items, item_id, item_text, text_col):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, words, keys, where = shared.value
            known = Items(ids, words)
            for batch in batches:
                marked = np.array(batch.column(place).to_pylist(), bool)
                texts = batch.column(batch.schema.get_field_index(text_col))
                marked[[m[0] for m in _matches(known, keys, where, texts)]] = True
                yield batch.set_column(place, flag, pa.array(marked))

        out = out.mapInArrow(run, fields)
    return out


ship(__name__)
