"""Uniform shuffle into shards of exact sizes (dealt operator 3).

Each partition permutes its rows and numbers them. A matrix says how many rows
each partition sends to each shard; it is drawn from the multivariate
hypergeometric law of a uniform permutation, with row sums the partitions' and
column sums the shards' exact sizes. Rows are exchanged by it and permuted
again within the shard.

Only the matrix is made on the driver, from one count for each partition; rows
are handled by DataFrame operations alone. No shard needs a single task: the
second permutation sorts ranges of its random key apart from each other, and a
row's place follows from the sizes of the ranges before.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import MAX_BROADCAST_BYTES, fresh, written

SEED = 20240229
RANGE_ROWS = 1 << 14
# numpy draws from populations below this.
POPULATION = 1_000_000_000


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among ``n`` drawn, for populations of any size."""
    if good + bad < POPULATION:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(a: int, b: int) -> float:
        return math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)

    peak = math.exp(log_choose(good, mode) + log_choose(bad, n - mode) - log_choose(good + bad, n))
    left = rng.random() - peak
    down, up, p_down, p_up = mode, mode, peak, peak
    # Outwards from the mode, by the ratio of neighbouring probabilities.
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def _draw(rng: np.random.Generator, room: np.ndarray, n: int) -> np.ndarray:
    if room.sum() < POPULATION:
        return rng.multivariate_hypergeometric(room, n, method="marginals")
    out, rest = np.zeros_like(room), int(room.sum())
    for j, size in enumerate(room.tolist()):
        rest -= size
        out[j] = _hypergeometric(rng, size, rest, n)
        n -= int(out[j])
    return out


def communication_matrix(rng: np.random.Generator, rows: list[int], room: np.ndarray) -> np.ndarray:
    """Rows that each partition sends to each shard; halves are split by exact draws."""
    if len(rows) <= 1:
        return room.reshape(len(rows), -1) if rows else np.zeros((0, len(room)), np.int64)
    half = len(rows) // 2
    first = _draw(rng, room, sum(rows[:half]))
    return np.concatenate(
        [communication_matrix(rng, rows[:half], first), communication_matrix(rng, rows[half:], room - first)]
    )


def shard_sizes(total: int, shards: int) -> np.ndarray:
    """Sizes that differ by one at most."""
    return np.array([total // shards + (j < total % shards) for j in range(shards)], np.int64)


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``df`` with columns ``shard`` and ``slot``, in uniformly random order.

    Shards are numbered from 0, their sizes differ by one at most, and slots run
    from 0 without gaps. All rows are kept, equal ones and such with nulls too;
    what they hold plays no part. Fewer rows than shards leave shards empty, an
    empty table gives no rows. The columns get underscores if a name is taken.
    The input is written once, so that its partitions stay as they were counted.
    """
    spark = df.sparkSession
    order, place, part, shard, slot, key, run, base = fresh(
        df, "order", "place", "part", "shard", "slot", "key", "run", "base"
    )
    mixed = df.withColumn(order, F.rand(seed)).sortWithinPartitions(order).drop(order)
    # The id is the partition's number and the row's place in it.
    staged = written(mixed.withColumn(place, F.monotonically_increasing_id()), "staged")
    part_of = F.shiftright(place, 33)
    # One row for each partition.
    counts = sorted(staged.groupBy(part_of.alias(part)).count().collect())
    total = sum(n for _, n in counts)
    matrix = communication_matrix(
        np.random.default_rng(seed), [n for _, n in counts], shard_sizes(total, shards)
    )
    ends = [(p, row.cumsum().tolist()) for (p, _), row in zip(counts, matrix, strict=True)]
    bounds = spark.createDataFrame(ends, f"`{part}` long, ends array<long>")
    if len(ends) * shards * 8 <= MAX_BROADCAST_BYTES:
        bounds = F.broadcast(bounds)
    bits = max(1, math.ceil(math.log2(max(1, total / shards / RANGE_ROWS))))

    def dealt(rows: DataFrame) -> DataFrame:
        rank = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
        random = F.xxhash64(F.lit(seed), place)
        return (
            rows.withColumn(part, part_of)
            .join(bounds, part)
            .withColumn(shard, F.size(F.filter("ends", lambda end: end <= rank)))
            .withColumn(key, random)
            .withColumn(run, F.shiftrightunsigned(key, 64 - bits))
            .drop(part, "ends")
        )

    before = W.partitionBy(shard).orderBy(run).rowsBetween(W.unboundedPreceding, -1)
    sizes = dealt(staged.select(place)).groupBy(shard, run).agg(F.count("*").alias("n"))
    bases = sizes.select(shard, run, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    within = W.partitionBy(shard, run).orderBy(key, place)
    placed = dealt(staged).withColumn(slot, F.row_number().over(within) - 1).join(bases, [shard, run])
    return placed.select(*df.columns, shard, (F.col(base) + F.col(slot)).alias(slot))
