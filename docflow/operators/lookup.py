"""Object lookup by (Bucket, Key) and its failures."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJECT_KEY = ["Bucket", "Key"]
OBJECT_PART = "object_part"
BROADCAST_BYTES = 64 * 1024 * 1024

# Takes notifications, gives those back whose object is stored, with its `content`.
Fetcher = Callable[[DataFrame], DataFrame]


def fetch_objects(notifications: DataFrame, objects: DataFrame) -> DataFrame:
    """Notifications with their object; those without one are left out.

    No side is broadcast by hint: Catalyst does so only below its size limit. An
    object named by very many messages makes a skewed partition that AQE splits.
    """
    return notifications.join(objects, OBJECT_KEY, "inner")


def missing_objects(notifications: DataFrame, objects: DataFrame) -> DataFrame:
    """Notifications whose object is not stored; reads only the keys of objects."""
    return notifications.join(objects.select(*OBJECT_KEY), OBJECT_KEY, "left_anti")


def table_fetcher(
    objects: DataFrame | Callable[[], DataFrame],
    content_col: str = "content",
    parts: int | None = None,
) -> Fetcher:
    """Lookup in a table of objects.

    A stream takes a function that opens the table: it is called for each batch and
    so sees what was stored since the last one. Of a table stored in ``parts`` folders
    by key hash, only those are read that hold keys of the batch; which they are is at
    most ``parts`` numbers.
    """

    def fetch(notifications: DataFrame) -> DataFrame:
        table = objects if isinstance(objects, DataFrame) else objects()
        if parts:
            part = F.pmod(F.xxhash64(*OBJECT_KEY), F.lit(parts)).cast("int")
            named = notifications.select(part.alias(OBJECT_PART)).distinct().collect()
            table = table.where(F.col(OBJECT_PART).isin([row[0] for row in named]))
        stored = table.select(*OBJECT_KEY, F.col(content_col).alias("content"))
        return fetch_objects(notifications, stored)

    return fetch


def null_safe_join(rows: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys that may be null; keys are kept once."""
    renamed = extra.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return rows.join(renamed, same, "left").drop(*[f"_right_{k}" for k in keys])


def row_bytes(rows: DataFrame) -> Column:
    """About how much memory the rows' strings need, summed over rows."""
    width = F.lit(64)
    for name, kind in rows.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return F.coalesce(F.sum(width.cast("bigint")), F.lit(0).cast("bigint"))


def broadcast_if_small(rows: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of rows whose measured ``size`` is within the limit.

    Broadcast targets leave a large table of objects where it is; past the limit
    the join shuffles both sides.
    """
    return F.broadcast(rows) if size <= limit else rows
