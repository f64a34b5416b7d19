"""Build, decode, split and deduplicate notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.envelope import (
    envelope_json,
    failure_reason,
    fields_of,
    notification_json,
    text_of,
)


def build_bodies(notifications: DataFrame) -> DataFrame:
    """Add ``Body``, the queue form of each (uid, Bucket, Key[, attempt][, topic]) row."""
    topic = F.col("topic") if "topic" in notifications.columns else None
    attempt = F.col("attempt") if "attempt" in notifications.columns else None
    message = notification_json("uid", "Bucket", "Key")
    return notifications.withColumn("Body", envelope_json(message, attempt, topic))


def decode_bodies(bodies: DataFrame) -> DataFrame:
    """Add uid, Bucket, Key and ``reason``; the raw body stays beside them.

    Rows with a null ``reason`` are usable. Each JSON level is parsed once for its
    fields and once for whether it is JSON at all, and all by generators: a filter on
    what those yield stays above them, whereas one on ``from_json`` would be pushed
    below and parse every body a second time.
    """
    outer = bodies.select("*", F.inline(F.array(fields_of("Body", "Message"))))
    outer = outer.toDF(*bodies.columns, "_message", "_bad_body")
    inner = outer.select("*", F.inline(F.array(fields_of(text_of("_message"), "uid", "Bucket", "Key"))))
    raw = inner.toDF(*outer.columns, "_uid", "_bucket", "_key", "_bad_message")
    reason = failure_reason(
        *map(F.col, ("Body", "_bad_body", "_message", "_bad_message", "_bucket", "_key"))
    )
    named = [text_of(c).alias(n) for c, n in (("_uid", "uid"), ("_bucket", "Bucket"), ("_key", "Key"))]
    # A struct in an array of one: the generator that keeps the filter on reason up.
    judged = F.struct(*named, reason.alias("reason"))
    return raw.select(*bodies.columns, F.inline(F.array(judged)))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason", "Body")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).drop("uid", "Bucket", "Key")


def delivery_id() -> Column:
    """Identity of a message: its uid, or the object it names where it has none."""
    return F.coalesce(F.col("uid"), F.concat_ws("/", F.col("Bucket"), F.col("Key")))


def dedup_notifications(notifications: DataFrame) -> DataFrame:
    """One row per message, the same one whatever the input order.

    Partial aggregation leaves at most one row per message and map task, so a
    message redelivered any number of times costs no more than the others.
    """
    return (
        notifications.groupBy(delivery_id().alias("_id"))
        .agg(F.min(F.struct("uid", "Bucket", "Key")).alias("_first"))
        .select("_first.uid", "_first.Bucket", "_first.Key")
    )


def distinct_targets(notifications: DataFrame) -> DataFrame:
    """One row per object to process; outputs are keyed by object.

    Its ``queues``, if there are any, are those of all its messages.
    """
    found = [F.min("uid").alias("uid")]
    if "queues" in notifications.columns:
        found.append(F.array_distinct(F.flatten(F.collect_set("queues"))).alias("queues"))
    return notifications.groupBy("Bucket", "Key").agg(*found)
