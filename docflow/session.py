"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE coalesces small shuffle partitions, so the width they start from may be
# generous on a cluster. `spark.sql.shuffle.partitions` is left alone: it also is
# the number of state stores of a stream, which nothing coalesces.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITIONS_PER_CORE = 10

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole documents pass through the Python slots, so batches stay short.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    # Keeps dedup state on executor disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "docflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    if not is_local(spark):
        widen_shuffles(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def widen_shuffles(spark: SparkSession) -> None:
    """Start batch shuffles with some partitions per core, unless that is set.

    Executors may still be starting, so the configured most of them count if they are
    named, and shuffles never get narrower than ``spark.sql.shuffle.partitions``.
    """
    if spark.conf.get(INITIAL_PARTITIONS, None) is not None:
        return
    conf = spark.sparkContext.getConf()
    most = int(conf.get("spark.dynamicAllocation.maxExecutors", "0"))
    cores = max(spark.sparkContext.defaultParallelism, most * int(conf.get("spark.executor.cores", "1")))
    wanted = max(PARTITIONS_PER_CORE * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))


def stored_once(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the scratch folder and read back, for what several readers share."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path under the shared folder named by ``spark.checkpoint.dir``.

    A cluster has to name that folder. Only a local session may go without: it
    gets a temporary folder, which is also set as its checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="docflow-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/docflow-{purpose}-{uuid.uuid4().hex}"
