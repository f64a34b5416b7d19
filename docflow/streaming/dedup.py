"""Dropping redelivered messages across micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def dedup_stream(
    stream: DataFrame, id_col: str, at_col: str, within: str = "10 minutes", salts: int = SALTS
) -> DataFrame:
    """First row per id within the given time; state older than that is dropped.

    Streams have no partial aggregation in front of this operator, so a message
    redelivered very often would meet in one task. It is therefore deduplicated
    per id and salt first - the salt is that of the map task - and then per id,
    where at most one row per salt is left. ``salts=1`` skips the first step.
    """
    marked = stream.withWatermark(at_col, within)
    if salts > 1:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        marked = (
            marked.withColumn("_salt", salt)
            .dropDuplicatesWithinWatermark([id_col, "_salt"])
            .drop("_salt")
        )
    return marked.dropDuplicatesWithinWatermark([id_col])
