"""Failed deliveries: numbering attempts, scheduling and finding those due."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as win

from docflow.functions.retry import delayed, retry_delay_ms
from docflow.operators.lookup import null_safe_join
from docflow.schemas import DEFAULT_DELAY_SECONDS


NEVER = "the next attempt is later than any timestamp"
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000


def number_attempts(
    failures: DataFrame,
    key_cols: Sequence[str],
    at_col: str,
    tie_cols: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    grain: str = "hour",
) -> DataFrame:
    """Add ``attempt``: 1, 2, ... per key in time order.

    A key of more than ``hot_rows`` rows is not sorted in a single task: its rows
    are numbered within one ``grain`` of time and shifted by the count of earlier
    ones. Those keys are broadcast after they have been counted; beyond
    ``max_hot_keys`` of them all keys are treated that way.
    """
    keys = list(key_cols)
    time_slice = F.date_trunc(grain, F.col(at_col))
    hot = failures.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*keys)
    n_hot = hot.limit(max_hot_keys + 1).count()
    if n_hot == 0:
        return _row_numbers(failures, keys, at_col, tie_cols)
    if n_hot <= max_hot_keys:
        marked = F.broadcast(hot.withColumn("_hot", F.lit(True)))
        rows = null_safe_join(failures, marked, keys).withColumn(
            "_slice", F.when(F.col("_hot"), time_slice)
        )
    else:
        rows = failures.withColumns({"_hot": F.lit(True), "_slice": time_slice})
    earlier = (
        win.Window.partitionBy(*keys)
        .orderBy("_slice")
        .rowsBetween(win.Window.unboundedPreceding, -1)
    )
    counts = rows.where("_hot").groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    shifts = counts.select(*keys, "_slice", F.sum("_n").over(earlier).alias("_shift"))
    numbered = _row_numbers(rows, [*keys, "_slice"], at_col, tie_cols)
    shifted = null_safe_join(numbered, shifts, [*keys, "_slice"])
    attempt = F.col("attempt") + F.coalesce("_shift", F.lit(0).cast("bigint"))
    return shifted.select(*failures.columns, attempt.alias("attempt"))


def _row_numbers(
    rows: DataFrame, group_cols: Sequence[str], at_col: str, tie_cols: Sequence[str]
) -> DataFrame:
    within = win.Window.partitionBy(*group_cols).orderBy(at_col, *tie_cols)
    return rows.withColumn("attempt", F.row_number().over(within).cast("bigint"))


def schedule(
    attempts: DataFrame, at_col: str = "last_attempt_at", strategy: str = "linear", **options
) -> DataFrame:
    """Add ``next_attempt_at``, the last attempt plus the delay of the strategy.

    It is null where that is later than any timestamp, and then a ``reason`` says so.
    """
    planned = attempts.withColumn(
        "next_attempt_at", delayed(at_col, retry_delay_ms("attempt", strategy, **options))
    )
    if "reason" not in attempts.columns:
        return planned
    never = F.col("next_attempt_at").isNull() & F.col(at_col).isNotNull()
    told = F.concat_ws("; ", F.col("reason"), F.when(never, NEVER))
    return planned.withColumn("reason", F.when(never, told).otherwise(F.col("reason")))


def push_back(entries: DataFrame, seconds: int = DEFAULT_DELAY_SECONDS) -> DataFrame:
    """Delay: make entries visible again no earlier than ``seconds`` after their
    last attempt."""
    return entries.withColumn(
        "next_attempt_at", delayed("last_attempt_at", F.lit(seconds * 1000))
    )


def due(entries: DataFrame, now: datetime | Column) -> DataFrame:
    """Entries whose next attempt is not in the future."""
    limit = now if isinstance(now, Column) else F.lit(now)
    return entries.where(F.col("next_attempt_at") <= limit)
