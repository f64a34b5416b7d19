"""How the given tables stand for notifications, objects, pages and attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.functions.keys import source_key
from docflow.schemas import BUCKET, PDF_SUBTYPE

# Documents in this language count as not stored yet, or as sent by a producer
# that cuts its messages short.
ODD_LANG = "fr"
MIN_PAGE_CHARS = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as stored objects, with the uid of their notification."""
    uid = F.md5(F.col("doc_id").cast("string"))
    return (
        table(spark, sf_dir, "documents")
        .withColumns({"uid": uid, "Bucket": F.lit(BUCKET)})
        .withColumn("Key", source_key("uid", "source"))
    )


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects(spark, sf_dir).select("uid", "Bucket", "Key")


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that are there when the notifications arrive."""
    docs = objects(spark, sf_dir).where(F.col("lang") != ODD_LANG)
    return docs.select("Bucket", "Key", "text")


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as attachments of the document with the conversation's number."""
    turns = table(spark, sf_dir, "conversations")
    subtype = F.when(F.col("role") == "assistant", PDF_SUBTYPE).otherwise("text/plain")
    return turns.select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("ordinal"),
        subtype.alias("subtype"),
        F.col("text").alias("content"),
    )
