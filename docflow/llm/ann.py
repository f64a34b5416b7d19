"""Nearest neighbours by cross-polytope hashing (dealt operator 10).

Vectors are brought to unit length and rotated by fast Hadamard transforms with
random signs, differently for each table; a vector's bucket is the signed axis
it is nearest to. A query looks into the buckets of its ``probes`` nearest axes
in each table, and what it finds is ranked by exact distances of the original
vectors. Queries whose buckets hold fewer than ``k`` rows are asked again, of
all rows.

Every row is in every table of its own task's index. Queries are sent to all
tasks in blocks of bounded size; a task answers with its nearest few for each
query, and those meet in one aggregation. So vectors never move, buckets of any
size are read whole, and only ``k`` rows for each query and task are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import ship, written

TABLES = 20
PROBES = 5
SEED = 7
BLOCK_QUERIES = 1 << 14
INDEX_ROWS = 1 << 14


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform, zero-padded to a power of two."""
    n, dims = x.shape
    size = 1 << max(0, (dims - 1).bit_length())
    out = np.zeros((n, size))
    out[:, :dims] = x
    rng = np.random.default_rng([SEED, table, size])
    for _ in range(3):
        out *= rng.choice((-1.0, 1.0), size)
        step = 1
        while step < size:
            pairs = out.reshape(n, size // (2 * step), 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            out = out.reshape(n, size)
            step *= 2
        out /= np.sqrt(size)
    return out


def axes(y: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest signed axes of each row, nearest first."""
    both = np.concatenate([y, -y], axis=1)
    n = min(n, both.shape[1])
    return np.argsort(-both, axis=1, kind="stable")[:, :n]


def clean(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Usable rows by number of dimensions: ids, and vectors in double precision."""
    rows: dict[int, tuple[list, list]] = {}
    for vec_id, vector in zip(ids.to_pylist(), vectors, strict=True):
        values = vector.values
        if vec_id is None or values is None or not len(values) or values.null_count:
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            kept = rows.setdefault(len(x), ([], []))
            kept[0].append(vec_id)
            kept[1].append(x)
    return {d: (np.array(i, np.int64), np.array(v)) for d, (i, v) in rows.items()}


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Index:
    """Tables of a batch of vectors: rows in the order of their buckets; no tables if all rows are searched."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, whole: bool = False):
        self.ids, self.vectors = ids, vectors
        x = unit(vectors)
        self.tables = []
        for table in range(0 if whole else TABLES):
            y = rotated(x, table)
            code = axes(y, 1)[:, 0]
            order = np.argsort(code, kind="stable")
            self.tables.append((order, np.searchsorted(code[order], np.arange(2 * y.shape[1] + 1))))

    def search(self, query_id: int, query: np.ndarray, probes: np.ndarray, k: int) -> tuple:
        """The ``k`` nearest of all rows in the probed buckets, without tables of all: scores and ids."""
        seen = np.full(len(self.ids), not self.tables)
        for (order, edges), codes in zip(self.tables, probes, strict=True):
            for code in codes:
                seen[order[edges[code] : edges[code + 1]]] = True
        seen &= self.ids != query_id
        rows = np.flatnonzero(seen)
        score = np.sqrt(((self.vectors[rows] - query) ** 2).sum(axis=1))
        return nearest(score, self.ids[rows], k)


def nearest(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` by score, then id; of rows with one id the nearest counts."""
    order = np.lexsort((ids, score))
    ids, score = ids[order], score[order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return score[first], ids[first]


def _answer(block: Callable[[], tuple], k: int, whole: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = {}
        for dims, (ids, vectors) in clean(*block()).items():
            x = unit(vectors)
            probes = np.zeros((len(ids), 0, 0), np.int64)
            if not whole:
                probes = np.stack([axes(rotated(x, t), PROBES) for t in range(TABLES)], axis=1)
            queries[dims] = (ids, vectors, probes)
        best: dict[tuple[int, int], tuple] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, INDEX_ROWS):
                some = batch.slice(at, INDEX_ROWS)
                for dims, (ids, vectors) in clean(some.column(0), some.column(1)).items():
                    if dims not in queries:
                        continue
                    index = Index(ids, vectors, whole)
                    for row, (query_id, query, probes) in enumerate(zip(*queries[dims], strict=True)):
                        score, found = index.search(query_id, query, probes, k)
                        if (dims, row) in best:
                            old = best[dims, row]
                            score, found = np.concatenate([old[0], score]), np.concatenate([old[1], found])
                            score, found = nearest(score, found, k)
                        best[dims, row] = (score, found)
        rows = [(queries[d][0][row], s, f) for (d, row), (s, f) in best.items() if len(s)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([r[0] for r in rows], [len(r[1]) for r in rows]), pa.int64()),
                    pa.array(np.concatenate([r[2] for r in rows]), pa.int64()),
                    pa.array(np.concatenate([r[1] for r in rows]), pa.float64()),
                ],
                ["query_id", "vec_id", "score"],
            )

    return run


def nearest_neighbours(
    df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest found rows of ``df`` for each row of ``queries``, by Euclidean distance.

    Rows of ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``; ties go to
    the smaller id, and a query never finds its own id. Ids or vectors that are
    null, vectors that are empty or zero or hold null or non-finite components
    take no part, and vectors are compared with those of as many dimensions
    only. Of rows that repeat an id the nearest counts, and queries that repeat
    an id are answered together. Other columns are ignored; without queries or
    candidates there are no rows. Fewer than ``k`` rows come back only if there
    are fewer candidates.
    """

    def slim(x: DataFrame) -> DataFrame:
        return x.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))

    rows = slim(df)
    asked = written(slim(queries).where("vec_id IS NOT NULL AND vector IS NOT NULL"), "queries")
    found = written(_ranked(rows, asked, k, False), "found")
    full = found.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    short = written(asked.join(full, "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return found
    # All rows are searched for these, so what the buckets held comes again.
    answered = found.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")
    return answered.unionAll(_ranked(rows, short, k, True))


def _ranked(rows: DataFrame, asked: DataFrame, k: int, whole: bool) -> DataFrame:
    """The ``k`` nearest for each query, of the probed buckets or of the ``whole`` table."""
    spark = rows.sparkSession
    n_blocks = -(-asked.count() // BLOCK_QUERIES)
    schema = "query_id long, vec_id long, score double"
    out = spark.createDataFrame([], schema)
    for block in range(n_blocks):
        # BLOCK_QUERIES rows or so: a bounded block of the query set.
        some = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block).toArrow()
        shared = spark.sparkContext.broadcast(
            (some.column(0).combine_chunks(), some.column(1).combine_chunks())
        )
        answers = rows.mapInArrow(_answer(lambda s=shared: s.value, k, whole), schema)
        out = out.unionAll(answers)
    best = out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ship(__name__)
