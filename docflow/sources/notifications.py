"""Notification inbox: a folder of JSON bodies, or a topic of a message broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.notifications import build_bodies
from docflow.schemas import BODY


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BODY).json(path)


def stream_bodies(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    archive: str | None = None,
    delete: bool = False,
) -> DataFrame:
    """Bodies as a stream, with the time of their batch as ``received_at``.

    A batch is bounded by files or by bytes. Files that were read may be moved to the
    folder ``archive`` or deleted; otherwise the inbox, and with it the listing the
    driver makes for each batch, grows with every message ever sent.

    The messages carry no time of their own, and by the time they are received
    none is ever late: a watermark on it bounds state but drops no message.
    """
    options = {
        "maxFilesPerTrigger": max_files_per_trigger,
        "maxBytesPerTrigger": max_bytes_per_trigger,
        "cleanSource": "archive" if archive else "delete" if delete else None,
        "sourceArchiveDir": archive,
    }
    return (
        spark.readStream.schema(BODY)
        .options(**{k: v for k, v in options.items() if v is not None})
        .json(path)
        .select("Body", F.current_timestamp().alias("received_at"))
    )


def stream_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int, **options: str
) -> DataFrame:
    """The same from Kafka; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .options(**options)
        .load()
        .select(
            F.col("value").cast("string").alias("Body"),
            F.current_timestamp().alias("received_at"),
        )
    )


def publish(notifications: DataFrame, path: str) -> None:
    """Append one body per notification to a folder inbox."""
    build_bodies(notifications).select("Body").write.mode("append").json(path)
