"""Language identification by nearest centroids (dealt operator 9).

Features are byte n-grams of lower-cased letters, hashed to ``DIMS`` counters,
weighted by tf-idf and brought to unit length. Each language has several
centroids, clustered by spherical k-means; a text gets the language of the
centroid with the greatest cosine. A text that is much farther away than nearly
all texts that made the centroid, its length considered, is rejected.

Only fitting uses a bounded sample: ``SAMPLE`` labelled rows a language, those
whose hashed id comes first. The model holds ``CENTROIDS * DIMS`` numbers a
language, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import broadcast_if_small, fresh, ship, written
from docflow.llm.words import flat, groups

UNKNOWN = "und"
DIMS = 1 << 12
SIZES = (1, 2, 3)
CENTROIDS = 3
ROUNDS = 8
SAMPLE = 400
# A text is rejected below this share of a low quantile of its cluster's own cosines.
SHARE = 0.6
QUANTILE = 0.02
# Clusters of fewer texts take the quantile of their language if that is lower.
FEW = 50
# A text of n n-grams comes as near as sqrt(n / (n + REACH)) of what a long one does:
# prefixes of 32, 128 and 512 bytes of the given texts have medians of 0.45, 0.65 and 0.82, whole texts 0.90.
REACH = 320

SLICE = 1 << 18
# Texts counted at once: each takes DIMS numbers in several arrays, however short it is.
ROWS = 128


def profile(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed counts of byte n-grams for each text, a row each; other bytes than letters are one gap."""
    n = len(offsets) - 1
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = letter[128:] = True
    table = np.where(letter, np.arange(256), 32).astype(np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    data = table[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32) | (owner[1:] != owner[:-1])
    data, owner = data[keep].astype(np.uint32), owner[keep]
    counts = np.zeros(n * DIMS, np.int64)
    for size in SIZES:
        m = len(data) - size + 1
        if m <= 0:
            continue
        code = np.zeros(m, np.uint32)
        for k in range(size):
            code = code * np.uint32(257) + data[k : k + m] + np.uint32(1)
        code = (code * np.uint32(2654435761)) >> np.uint32(20)
        whole = owner[:m] == owner[size - 1 :]
        counts += np.bincount((owner[:m] * DIMS + code)[whole], minlength=n * DIMS)
    return counts.reshape(n, DIMS)


def unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def profiles(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Counts for runs of texts; texts longer than a slice are counted slice by slice."""
    data, offsets = flat(column)
    for i, j in groups(offsets, SLICE, ROWS):
        if j > i + 1:
            yield i, j, profile(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            continue
        total = np.zeros((1, DIMS), np.int64)
        for at in range(offsets[i], offsets[j], SLICE):
            # Slices share the bytes that n-grams need; the gap counted twice is one in thousands.
            end = min(at + SLICE + max(SIZES) - 1, offsets[j])
            total += profile(data[at:end], np.array([0, end - at]))
        yield i, j, total


def reach(counts: np.ndarray) -> np.ndarray:
    """What share of a long text's cosine a text of so many n-grams can be held to."""
    n = counts.sum(axis=1)
    return np.sqrt(n / (n + REACH))


def cluster(x: np.ndarray, k: int, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the farthest texts; centroids and the least cosine a long text needs for each."""
    seeds = [0]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin((x @ x[seeds].T).max(axis=1))))
    centers = x[seeds]
    for _ in range(ROUNDS):
        near = (x @ centers.T).argmax(axis=1)
        sums = np.stack([x[near == c].sum(axis=0) for c in range(len(centers))])
        centers = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, unit(sums), centers)
    cosine = x @ centers.T
    near = cosine.argmax(axis=1)
    best = cosine.max(axis=1) / reached
    low = np.quantile(best, QUANTILE)
    own = [np.quantile(best[near == c], QUANTILE) if (near == c).any() else low for c in range(len(centers))]
    few = np.bincount(near, minlength=len(centers)) < FEW
    return centers, SHARE * np.where(few, np.minimum(own, low), own).clip(0, 1)


class Model:
    """Centroids of all languages with their bounds, and the idf weights."""

    def __init__(self, idf: np.ndarray, names: list[str], centers: np.ndarray, bound: np.ndarray):
        self.idf, self.names, self.centers, self.bound = idf, names, centers, bound

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts) * self.idf)

    def __call__(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each row of counts."""
        if not self.names:
            n = len(counts)
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        cosine = self.vectors(counts) @ self.centers.T
        near = cosine.argmax(axis=1)
        best = cosine[np.arange(len(near)), near].clip(0, 1)
        return [self.names[c] for c in near], best, best < self.bound[near] * reach(counts)


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, counts in profiles(batch.column(1)):
            rows = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, j - i),
                    pa.array([r.tolist() for r in rows], pa.list_(pa.int32())),
                    pa.array([c[r].tolist() for c, r in zip(counts, rows, strict=True)], pa.list_(pa.int64())),
                ],
                ["lang", "slots", "counts"],
            )


def _dense(slots, counts) -> np.ndarray:
    x = np.zeros((len(slots), DIMS))
    for row, (s, c) in enumerate(zip(slots, counts, strict=True)):
        x[row, s] = c
    return x


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", order: Column | None = None) -> Model:
    """Learn centroids from labelled rows; rows without text, letters or language are left out.

    Each language is clustered in a task of its own from ``SAMPLE`` rows at
    most, those of least ``order``, a 64-bit hash (default: of the text). An
    empty table gives a model that rejects everything.
    """
    rank = F.xxhash64(F.col(text_col)) if order is None else order
    labelled = df.select(
        F.col(lang_col).cast("string").alias("lang"), F.lower(text_col).alias("text"), rank.alias("rank")
    ).where(F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}"))
    # Ranks alone are compared; whole texts are read for the chosen ones only. Ranks
    # are uniform, so a share of them that follows from their number holds the first
    # SAMPLE, and some thousand rows a language are sorted however many there are.
    ranks = labelled.select("lang", "rank").distinct()
    totals = ranks.groupBy("lang").agg(F.count("*").alias("total"))
    place = (F.col("rank").cast("double") + 2.0**63) / 2.0**64
    near = ranks.join(totals, "lang").where(place * F.col("total") <= 4 * SAMPLE)
    best = W.partitionBy("lang").orderBy("rank")
    chosen = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= SAMPLE)
    # SAMPLE rows a language: texts stay where they are.
    chosen = broadcast_if_small(written(chosen.select("lang", "rank"), "chosen"), 64)
    texts = labelled.join(chosen, ["lang", "rank"]).dropDuplicates(["lang", "rank"]).select("lang", "text")
    spread = texts.repartition(df.sparkSession.sparkContext.defaultParallelism)
    counted = spread.mapInArrow(_count_texts, "lang string, slots array<int>, counts array<long>").persist()
    try:
        # DIMS numbers, whatever the corpus.
        seen = dict(counted.select(F.explode("slots").alias("s")).groupBy("s").count().collect())
        n = counted.count()
        idf = np.array([np.log((1 + n) / (1 + seen.get(s, 0))) + 1 for s in range(DIMS)])

        def clusters(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            counts = _dense(rows["slots"], rows["counts"])
            x = unit(np.log1p(counts) * idf)
            order = np.lexsort(x.T[:8])
            centers, bound = cluster(x[order], CENTROIDS, reach(counts[order]))
            return pd.DataFrame({"lang": key[0], "center": centers.tolist(), "bound": bound})

        found = counted.groupBy("lang").applyInPandas(
            clusters, "lang string, center array<double>, bound double"
        )
        # CENTROIDS rows a language.
        model = sorted(found.collect(), key=lambda r: (r["lang"], r["center"]))
    finally:
        counted.unpersist()
    centers = np.array([r["center"] for r in model]).reshape(len(model), DIMS)
    return Model(idf, [r["lang"] for r in model], centers, np.array([r["bound"] for r in model]))


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    A null text, or one without a letter, is ``und`` with score 0 and rejected.
    Names that ``df`` has already are prefixed with underscores. Equal texts get
    equal answers; ties between centroids go to the first language by name.
    """
    lower, letters, pred, score, rejected = fresh(df, "low", "letters", "lang_pred", "score", "rejected")
    names = [*df.columns, pred, score, rejected]
    parts = (model.idf, model.names, model.centers, model.bound)
    shared = df.sparkSession.sparkContext.broadcast(parts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        for batch in batches:
            low = batch.column(batch.schema.get_field_index(lower))
            has = batch.column(batch.schema.get_field_index(letters))
            kept = [batch.column(i) for i in range(batch.num_columns - 2)]
            for i, j, counts in profiles(low):
                lang, cosine, far = known(counts)
                word = np.array(has.slice(i, j - i).fill_null(False).to_pylist(), bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(i, j - i) for c in kept),
                        pa.array([name if ok else UNKNOWN for name, ok in zip(lang, word, strict=True)]),
                        pa.array(np.where(word, cosine, 0.0)),
                        pa.array(far | ~word),
                    ],
                    names,
                )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)
    plain = df.withColumns(
        {lower: F.lower(text_col), letters: F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))}
    )
    return plain.mapInArrow(judge, f"{fields}`{pred}` string, `{score}` double, `{rejected}` boolean")


ship(__name__)
