"""Helpers shared by the operators: written tables, shipping code, checked broadcasts."""

from __future__ import annotations

import sys
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import DEFAULTS, scratch_dir

MAX_BROADCAST_BYTES = 64 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(module: str) -> None:
    """Pickle a module's functions by value, so that workers need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str, per_core: int | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage.

    ``per_core`` bounds the number of files, for tables that are much smaller than what
    they are made of: on a local disk an executor starts processes for each file (chmod).
    """
    spark = df.sparkSession
    if per_core:
        df = df.coalesce(per_core * spark.sparkContext.defaultParallelism)
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession) -> None:
    """From now on tasks pass 512 rows at most to Python at once, as in the sessions of this package.

    Spark's 10,000 whole documents are copied several times in an executor and its workers.
    Results are lazy, so the setting stays; a smaller one is left alone.
    """
    most, now = int(DEFAULTS[BATCH_ROWS]), int(spark.conf.get(BATCH_ROWS))
    if not 0 < now <= most:
        spark.conf.set(BATCH_ROWS, str(most))


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Mark a written table for broadcast if its rows take ``limit`` bytes at most.

    Beyond that the join is left to shuffle; the rows are the same either way.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names near ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(col: Column | str) -> Column:
    """A-Z to lower case, other letters as they are."""
    col = F.col(col) if isinstance(col, str) else col
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker and is shared by its tasks."""
    key = "docflow_worker_cache"
    return vars(sys.modules.setdefault(key, ModuleType(key))).setdefault(name, {})


ship(__name__)
