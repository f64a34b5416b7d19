"""Counts of a run: as a table, or observed while the run goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("documents"),
        F.sum("n_pages").alias("pages_found"),
        F.sum("pages_processed").alias("pages_processed"),
        F.sum(F.col("truncated").cast("bigint")).alias("documents_truncated"),
        F.sum("content_length").alias("bytes_written"),
    ]


def run_summary(texts: DataFrame) -> DataFrame:
    """One row of totals over the text stage's output."""
    return texts.agg(*_totals())


def observed(texts: DataFrame, name: str = "text_stage") -> tuple[DataFrame, Observation]:
    """The same totals, collected by whatever action the rows go into."""
    observation = Observation(name)
    return texts.observe(observation, *_totals()), observation
