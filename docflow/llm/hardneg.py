"""Hard negatives by exact integer scores (dealt operator 11).

Vectors are quantised to integers, ``floor(256 * x)`` with ``x`` in double
precision, and scored by their integer inner product with an anchor. Scores of
a block of anchors against a batch of rows come from Strassen's recursive
multiplication: the two matrices are padded with zeros to a multiple of
``2 ** levels`` in every dimension and split in quarters, seven products a
level instead of eight, down to leaves that numpy multiplies. All additions are
exact integer additions; where the values could leave int64, Python integers
take their place, so a score is never rounded.

Two mergeable heaps follow. First each task keeps, for each anchor, its best
``positives`` rows of the anchor's label; a window keeps the best of those of
all tasks. Then each task sorts its rows of other labels by score for each
anchor: the window ``30 * p <= 100 * n <= 90 * p`` of a positive's score ``p``
is one contiguous run of that order, whose first ``negatives`` rows are that
task's heap; again a window keeps the best of all tasks.

Anchors move in blocks of bounded bytes through the driver into the tasks'
closures; every block reads all rows, as the contract asks of every anchor.
Rows never move, and a task sends at most ``positives`` or
``positives * negatives`` rows an anchor.

Defined results for odd input:

* rows with a null id, null label, null vector, or a null, NaN or infinite
  component take no part; vectors of another length than an anchor's are not
  compared with it; an empty vector scores 0 against other empty vectors;
* "other rows" of an anchor are the rows with another ``vec_id``; a repeated
  anchor row gives its result once for each copy, a repeated candidate row
  is a candidate once for each copy;
* ties of score go to the smaller ``vec_id``; anchors without positives, and
  positives without a negative in their window, give no rows;
* an empty table gives an empty result; other columns of the input are not read;
* order is always exact; a score beyond the range of a long (components near
  1e7 and above) is given as the nearest long.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import ship, written

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
SCALE = 256
LEVELS = 2
LEAF = 16
#: Bytes of one block of anchors in a task's closure, and of the scores of a slice of rows against it.
BLOCK_BYTES = 16 << 20
SCORE_BYTES = 64 << 20
INT64_SAFE = 1 << 62


def strassen(a: np.ndarray, b: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Exact product of two integer matrices by Strassen's recursion.

    Dimensions are padded with zeros to multiples of ``2 ** levels``; a level
    stops early when a dimension is below ``LEAF``. ``object`` arrays hold
    Python integers and stay exact at any size.
    """
    m, k = a.shape
    n = b.shape[1]
    if levels == 0 or min(m, k, n) < LEAF:
        return np.dot(a, b)
    step = 1 << levels
    mp, kp, np_ = (-(-s // step) * step for s in (m, k, n))
    if (mp, kp, np_) != (m, k, n):
        a = np.pad(a, ((0, mp - m), (0, kp - k)))
        b = np.pad(b, ((0, kp - k), (0, np_ - n)))
    h, g, e = mp // 2, kp // 2, np_ // 2
    a11, a12, a21, a22 = a[:h, :g], a[:h, g:], a[h:, :g], a[h:, g:]
    b11, b12, b21, b22 = b[:g, :e], b[:g, e:], b[g:, :e], b[g:, e:]
    low = levels - 1
    m1 = strassen(a11 + a22, b11 + b22, low)
    m2 = strassen(a21 + a22, b11, low)
    m3 = strassen(a11, b12 - b22, low)
    m4 = strassen(a22, b21 - b11, low)
    m5 = strassen(a11 + a12, b22, low)
    m6 = strassen(a21 - a11, b11 + b12, low)
    m7 = strassen(a12 - a22, b21 + b22, low)
    out = np.empty((mp, np_), dtype=m1.dtype)
    out[:h, :e] = m1 + m4 - m5 + m7
    out[:h, e:] = m3 + m5
    out[h:, :e] = m2 + m4
    out[h:, e:] = m1 - m2 + m3 + m6
    return out[:m, :n]


def quantised(vectors: list) -> np.ndarray:
    """``floor(256 * x)`` of rows of equal length; whole numbers held exactly in doubles."""
    return np.floor(np.asarray(vectors, dtype=np.float64).reshape(len(vectors), -1) * SCALE)


def ranked(row: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions by score, highest first, ties to the smaller id."""
    if row.dtype != object:
        return np.lexsort((ids, -row))
    return np.array(sorted(range(len(row)), key=lambda j: (-row[j], ids[j])), dtype=np.int64)


def as_long(values: np.ndarray) -> np.ndarray:
    """Scores as int64, those beyond its range at its ends."""
    if values.dtype != object:
        return values.astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([min(max(int(v), low), high) for v in values], dtype=np.int64)


def run_between(desc: np.ndarray, top, bottom) -> tuple[int, int]:
    """The run of ``desc`` (sorted from high to low) with ``bottom <= value <= top``."""
    keys = -desc
    if desc.dtype == object:
        keys = list(keys)
        return bisect.bisect_left(keys, -top), bisect.bisect_right(keys, -bottom)
    return int(np.searchsorted(keys, -top, side="left")), int(np.searchsorted(keys, -bottom, side="right"))


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of quantised anchors (b x d) and rows (c x d), exact."""
    d = anchors.shape[1]
    most = max(float(np.abs(anchors).max(initial=0)), float(np.abs(rows).max(initial=0)))
    # Strassen's sums grow operands by 2 a level on each side, then d products are added.
    if most * most * max(d, 1) * (4**LEVELS) < INT64_SAFE:
        return strassen(anchors.astype(np.int64), rows.astype(np.int64).T)
    to_int = np.vectorize(int, otypes=[object])
    return strassen(to_int(anchors), to_int(rows).T)


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Rows that take part, relabelled, as (vec_id, label, vec)."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    label = F.col(label_col)
    relabelled = F.when(F.col(id_col) % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    return vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & v.isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"),
        relabelled.cast("long").alias("label"),
        v.cast("array<double>").alias("vec"),
    )


def _blocks(anchors: DataFrame, dims: int) -> Iterator[pd.DataFrame]:
    """Anchors in blocks of at most ``BLOCK_BYTES`` of quantised values, one partition at a time."""
    size = max(1, BLOCK_BYTES // (8 * max(dims, 1)))
    held: list = []
    for row in anchors.toLocalIterator(prefetchPartitions=False):
        held.append(row)
        if len(held) == size:
            yield pd.DataFrame(held, columns=anchors.columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=anchors.columns)


def _slices(batches: Iterator[pd.DataFrame], anchors: int) -> Iterator[pd.DataFrame]:
    """Rows in slices whose scores against ``anchors`` anchors take ``SCORE_BYTES`` at most."""
    size = max(1, SCORE_BYTES // (8 * max(anchors, 1)))
    for batch in batches:
        for start in range(0, len(batch), size):
            yield batch.iloc[start : start + size]


def _positive_heaps(block: pd.DataFrame, k: int):
    """Each task's best ``k`` rows of the anchor's label, for every anchor of the block."""
    a_ids = block["vec_id"].to_numpy(np.int64)
    a_labels = block["label"].to_numpy(np.int64)
    a_q = quantised(list(block["vec"]))
    slot = block["slot"].to_numpy(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches, len(a_ids)):
            batch = batch[batch["vec"].map(len) == a_q.shape[1]]
            if batch.empty:
                continue
            ids = batch["vec_id"].to_numpy(np.int64)
            labels = batch["label"].to_numpy(np.int64)
            s = scores(a_q, quantised(list(batch["vec"])))
            out = []
            for i in range(len(a_ids)):
                mine = np.flatnonzero((labels == a_labels[i]) & (ids != a_ids[i]))
                if not len(mine):
                    continue
                row = s[i, mine]
                order = ranked(row, ids[mine])[:k]
                out.append(
                    pd.DataFrame({"slot": slot[i], "vec_id": ids[mine][order], "score": as_long(row[order])})
                )
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def _negative_heaps(block: pd.DataFrame, positive_scores: dict[int, np.ndarray], k: int):
    """Each task's first ``k`` rows of another label in the window of each positive."""
    a_ids = block["vec_id"].to_numpy(np.int64)
    a_labels = block["label"].to_numpy(np.int64)
    a_q = quantised(list(block["vec"]))
    slot = block["slot"].to_numpy(np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches, len(a_ids)):
            batch = batch[batch["vec"].map(len) == a_q.shape[1]]
            if batch.empty:
                continue
            ids = batch["vec_id"].to_numpy(np.int64)
            labels = batch["label"].to_numpy(np.int64)
            s = scores(a_q, quantised(list(batch["vec"])))
            out = []
            for i in range(len(a_ids)):
                wanted = positive_scores.get(int(slot[i]))
                others = np.flatnonzero(labels != a_labels[i])
                if wanted is None or not len(others):
                    continue
                row = s[i, others]
                order = ranked(row, ids[others])
                desc, desc_ids = row[order], ids[others][order]
                for j, p in enumerate(wanted):
                    p = int(p)
                    if LOW * p > HIGH * p:
                        continue
                    # 100 n <= 90 p  <=>  n <= floor(90 p / 100); 30 p <= 100 n  <=>  n >= ceil(30 p / 100).
                    top, bottom = (HIGH * p) // 100, -((-LOW * p) // 100)
                    lo, hi = run_between(desc, top, bottom)
                    take = slice(lo, min(hi, lo + k))
                    if take.start < take.stop:
                        out.append(
                            pd.DataFrame(
                                {
                                    "slot": slot[i],
                                    "p": j,
                                    "vec_id": desc_ids[take],
                                    "score": as_long(np.asarray(desc[take])),
                                }
                            )
                        )
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for all anchors.

    Anchors are the usable rows whose id is divisible by ``ANCHOR_EVERY``; see the
    module's docstring for the rules.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, vec_col, label_col), "hardneg-rows")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).withColumn("slot", F.monotonically_increasing_id())
    anchors = written(anchors, "hardneg-anchors")
    heap_schema = "slot long, vec_id long, score long"
    window_schema = "slot long, p long, vec_id long, score long"
    found: list[DataFrame] = []
    dims = [r[0] for r in anchors.select(F.size("vec").alias("d")).distinct().collect()]
    for d in dims:
        for block in _blocks(anchors.where(F.size("vec") == d), d):
            same = rows.where(F.size("vec") == d).select("vec_id", "label", "vec")
            tops = same.mapInPandas(_positive_heaps(block, positives), heap_schema)
            best = W.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
            pos = written(
                tops.withColumn("p", F.row_number().over(best) - 1).where(F.col("p") < positives), "hardneg-pos"
            )
            # At most ``positives`` scores an anchor of a bounded block: safe to hold.
            by_slot: dict[int, list] = {}
            for r in pos.orderBy("slot", "p").collect():
                by_slot.setdefault(r["slot"], []).append(r["score"])
            wanted = {s: np.array(v, dtype=object) for s, v in by_slot.items()}
            if not wanted:
                continue
            heaps = same.mapInPandas(_negative_heaps(block, wanted, negatives), window_schema)
            first = W.partitionBy("slot", "p").orderBy(F.desc("score"), "vec_id")
            neg = heaps.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
            ids = spark.createDataFrame(block[["slot", "vec_id"]].rename(columns={"vec_id": "anchor_id"}))
            result = neg.join(
                pos.select("slot", "p", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                ["slot", "p"],
            ).join(F.broadcast(ids), "slot")
            found.append(
                written(
                    result.select(
                        F.col("anchor_id").cast("long"),
                        "positive_id",
                        F.col("rank").cast("int"),
                        F.col("vec_id").alias("negative_id"),
                        "positive_score",
                        F.col("score").alias("negative_score"),
                    ),
                    "hardneg-out",
                )
            )
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


ship(__name__)
