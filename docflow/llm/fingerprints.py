"""Document fingerprints by consistent weighted sampling (dealt operator 13).

A text's weighted set is its word 5-shingles (words as in ``words``: runs of
non-space bytes, A-Z lower-cased), each weighted by how often it occurs; with
fewer than five words the whole word sequence is one shingle, without words
the set is empty.

Each shingle ``k`` of weight ``S`` draws, from its own hash, ``r, c ~ Gamma(2, 1)``
and ``b ~ Uniform(0, 1)`` (improved consistent weighted sampling):
``t = floor(ln S / r + b)``, ``y = exp(r (t - b))``, ``a = c / (y exp(r))``; a
sample is the ``(k, t)`` of least ``a``. Two sets agree on a sample with the
probability of their generalised Jaccard similarity, ``sum min / sum max``.

So that a text costs in proportion to its shingles rather than shingles times
samples, every shingle draws in one of ``SAMPLES`` bins chosen by its hash
(one-permutation binning), and an empty bin takes the sample of the first
filled bin in a fixed random order of its own (optimal densification). Within
a bin the agreement rate is that bin's generalised Jaccard similarity.

A fingerprint is the ``SAMPLES`` samples as 32-bit hashes in hex; likeness is
the share of equal samples. Equal texts have equal fingerprints.

The edited text of a document replaces its last ``floor(n / 3)`` code points by
the first as many (or all) of the next document in descending ``doc_id``; after
the last comes the first. Only keys are sorted and numbered (from per-partition
counts), and each text moves once, to the task of its part of the order; no
step needs one task for all rows.

Defined results for odd input: a null text is empty; an empty set has the
empty fingerprint, whose likeness is 1 with another empty one and 0 with any
other; null ``doc_id`` rows come last in the order; rows equal in ``doc_id``
are ordered by ``xxhash64`` of their text, then by their place in the input; a table of one row
edits its text with itself; an empty table gives no rows; very long texts are
hashed whole, in slices of bounded bytes; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docflow.llm import words
from docflow.llm.common import broadcast_if_small, ship, written

WIDTH = 5
SAMPLES = 64
SEED = 0x5EED_C0DE_2024
PART_BITS = 33


def _uniform(x: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) from 64-bit ``x`` and ``salt``."""
    with np.errstate(over="ignore"):
        h = words.mix(x + np.uint64((salt * 0x9E3779B97F4A7C15 + SEED) & ((1 << 64) - 1)))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def weighted_shingles(hashes: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles of each document and how often each occurs."""
    first = np.concatenate(([0], np.cumsum(counts)))
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for k in range(width):
            rolled = words.mix(rolled + hashes[k : k + len(rolled)] + np.uint64(k + 1))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1], return_counts=True))
        elif b > a:
            short = np.uint64(0xD6E8FEB86659FD93)
            for h in hashes[a:b]:
                with np.errstate(over="ignore"):
                    short = words.mix(np.atleast_1d(short + h))[0]
            out.append((np.array([short], np.uint64), np.array([1])))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def _borrow_order(samples: int) -> np.ndarray:
    """For each bin, a fixed random order of all bins, itself first."""
    rng = np.random.default_rng(SEED)
    order = np.empty((samples, samples), np.int64)
    for j in range(samples):
        rest = rng.permutation(np.delete(np.arange(samples), j))
        order[j] = np.concatenate(([j], rest))
    return order


BORROW = _borrow_order(SAMPLES)


def sketch(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``SAMPLES`` 32-bit samples of one weighted set (empty for an empty set)."""
    if not len(terms):
        return np.zeros(0, np.uint32)
    w = weights.astype(np.float64)
    r = -np.log(_uniform(terms, 1) * _uniform(terms, 2))
    c = -np.log(_uniform(terms, 3) * _uniform(terms, 4))
    b = _uniform(terms, 5)
    t = np.floor(np.log(w) / r + b)
    ln_a = np.log(c) - r * (t - b) - r
    bins = (words.mix(terms ^ np.uint64(SEED)) % np.uint64(SAMPLES)).astype(np.int64)
    order = np.lexsort((terms, ln_a, bins))
    first = np.ones(len(order), bool)
    first[1:] = bins[order][1:] != bins[order][:-1]
    chosen = order[first]
    value = np.zeros(SAMPLES, np.uint64)
    filled = np.zeros(SAMPLES, bool)
    with np.errstate(over="ignore"):
        value[bins[chosen]] = words.mix(terms[chosen] + t[chosen].astype(np.int64).astype(np.uint64) * np.uint64(0x9E37))
    filled[bins[chosen]] = True
    source = BORROW[np.arange(SAMPLES), np.argmax(filled[BORROW], axis=1)]
    return (value[source] >> np.uint64(32)).astype(np.uint32)


def as_text(samples: np.ndarray) -> str:
    return "".join(f"{int(v):08x}" for v in samples)


def likeness(x: str | None, y: str | None) -> float:
    """Share of equal samples; two empty fingerprints are alike, an empty and another not."""
    x, y = x or "", y or ""
    if not x or not y:
        return 1.0 if x == y else 0.0
    n = len(x) // 8
    return sum(x[8 * i : 8 * i + 8] == y[8 * i : 8 * i + 8] for i in range(n)) / n


def fingerprints(texts: pa.Array) -> list[str]:
    """The fingerprint of each text of an Arrow column."""
    out: list[str] = []
    for _, _, hashes, counts in words.hashed(texts):
        out += [as_text(sketch(k, w)) for k, w in weighted_shingles(hashes, counts)]
    return out


def _printer(text_col: str, out_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            printed = pa.array(fingerprints(batch.column(text_col)), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, printed], [*batch.schema.names, out_col])

    return run


def _plus(df: DataFrame, name: str, kind) -> StructType:
    """The schema of ``df`` and one more column; ``df.schema`` itself is left alone."""
    return StructType([*df.schema.fields, StructField(name, kind)])


def with_fingerprint(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    return df.mapInArrow(_printer(text_col, out_col), _plus(df, out_col, StringType()))


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
#: Rows of a part of the order; a part is paired by one task, so tasks keep their size at every scale.
PART_ROWS = 1 << 14


def order_key(doc_id, text_hash: int, seq: int) -> tuple:
    """Descending doc_id with nulls last, then text hash, then place in the input."""
    return (doc_id is None, -(doc_id or 0), text_hash, seq)


def numbered(keys: DataFrame, order: list) -> DataFrame:
    """Small key rows with ``rank`` 0, 1, ... in ``order``, from a range-partitioned sort."""
    placed = written(keys.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "fingerprint-order")
    part = F.shiftright("_at", PART_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row for each partition of the sort: bounded by the partition count, not the rows.
    starts = written(sizes.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))), "fingerprint-starts")
    starts = broadcast_if_small(starts, 24)
    low = F.col("_at").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    return placed.withColumn("_part", part).join(starts, "_part").select(
        *keys.columns, (F.col("_from") + low).alias("rank")
    )


def _parted(firsts: list[tuple]):
    """Each row's part: the last part whose first key is not above the row's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "seq")), strict=True)
            parts = [bisect.bisect_right(firsts, order_key(*k)) - 1 for k in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.int64())], [*batch.schema.names, "part"])

    return run


def _paired():
    """Rows of parts in order, each part closed by a row that holds what follows it.

    Each row is finished with the next one of its part; the last with the closing
    row, which brings the beginning of the next part's first text and its print.
    """

    def finish(row: tuple, next_text: str, next_print: str) -> tuple:
        doc_id, text, own = row
        n = len(text)
        cut = n // 3
        edited = text[: n - cut] + next_text[:cut]
        edited_print = fingerprints(pa.array([edited], pa.string()))[0]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        return doc_id, n, digest, own, edited_print, likeness(own, edited_print), likeness(own, next_print)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            texts = batch.column("text")
            prints = fingerprints(texts)
            out = []
            for doc_id, text, closing, given, own in zip(
                batch.column("doc_id").to_pylist(),
                texts.to_pylist(),
                batch.column("closing").to_pylist(),
                batch.column("next_print").to_pylist(),
                prints,
                strict=True,
            ):
                if closing:
                    out.append(finish(held, text, given))
                    held = None
                    continue
                if held is not None:
                    out.append(finish(held, text, own))
                held = (doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(NAMES, r, strict=True)) for r in out], SCHEMA)

    return run


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Only small keys are sorted and numbered. The rank of every ``part_rows``-th
    key makes the parts; each text is sent once to the task of its part, which
    sorts it and pairs every row with the next. The last row of a part gets the
    beginning of the next part's first text, fetched once for each part and sent
    with the part as its closing row. ``docs``
    is read several times and has to give the same rows in the same places each
    time, as a table does.
    """
    spark = docs.sparkSession
    src = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    src = src.withColumns({"th": F.xxhash64("text"), "seq": F.monotonically_increasing_id()})
    order = [F.col("doc_id").desc_nulls_last(), F.col("th"), F.col("seq")]
    ranked = numbered(src.select("doc_id", "th", "seq", F.char_length("text").alias("n")), order)
    total = ranked.count()
    if total == 0:
        return spark.createDataFrame([], OUT)
    part_rows = PART_ROWS
    parts = -(-total // part_rows)
    edge = (F.col("rank") % part_rows == 0) | (F.col("rank") % part_rows == part_rows - 1) | (F.col("rank") == total - 1)
    # Two rows for each part: bounded by the number of parts, not by rows or texts.
    edges = ranked.where(edge).select("rank", "doc_id", "th", "seq", "n").orderBy("rank").collect()
    firsts = [order_key(r.doc_id, r.th, r.seq) for r in edges if r.rank % part_rows == 0]
    first_seq = {r.rank // part_rows: r.seq for r in edges if r.rank % part_rows == 0}
    last_n = {r.rank // part_rows: r.n for r in edges if r.rank % part_rows == part_rows - 1 or r.rank == total - 1}
    asks = spark.createDataFrame(
        [(p, first_seq[(p + 1) % parts], last_n[p] // 3) for p in range(parts)], "part long, seq long, cut long"
    )
    # One closing row for each part: the beginning of the next part's first text and its print.
    closing = with_fingerprint(
        src.join(F.broadcast(asks), "seq").select("part", "text", F.expr("substring(text, 1, cut)").alias("prefix")),
        "text",
        "next_print",
    ).select(
        F.lit(None).cast("long").alias("doc_id"),
        F.col("prefix").alias("text"),
        F.lit(None).cast("long").alias("th"),
        F.lit(None).cast("long").alias("seq"),
        "part",
        F.lit(True).alias("closing"),
        "next_print",
    )
    routed = src.mapInArrow(_parted(firsts), _plus(src, "part", LongType())).select(
        "doc_id", "text", "th", "seq", "part", F.lit(False).alias("closing"), F.lit(None).cast("string").alias("next_print")
    )
    ordered = routed.unionByName(closing).repartition(parts, "part").sortWithinPartitions("part", "closing", *order)
    return ordered.select("doc_id", "text", "closing", "next_print").mapInArrow(_paired(), OUT)


ship(__name__)
