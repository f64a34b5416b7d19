"""Publish/subscribe: every message of a topic goes to each subscribed queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.schemas import DEFAULT_SUBSCRIPTIONS, TOPIC

MAX_BROADCAST_ROWS = 10_000
SALTS = 32


def subscribed_queues(
    topic: Column, subscriptions: Sequence[tuple[str, str]] = tuple(DEFAULT_SUBSCRIPTIONS)
) -> Column:
    """The distinct queues of a topic as an array, empty if there are none."""
    queues: dict[str, set[str]] = {}
    for name, queue in subscriptions:
        queues.setdefault(name, set()).add(queue)
    chosen = F.array().cast("array<string>")
    for name, names in queues.items():
        chosen = F.when(topic == name, F.array(*map(F.lit, sorted(names)))).otherwise(chosen)
    return chosen


def fan_out(
    notifications: DataFrame,
    subscriptions: DataFrame | Sequence[tuple[str, str]] = tuple(DEFAULT_SUBSCRIPTIONS),
    topic: str = TOPIC,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Copy each notification once per distinct queue subscribed to its topic.

    The topic comes from a ``topic`` column if there is one. Subscriptions given as
    a list become part of the projection. As a table they are broadcast after their
    number has been checked; above the limit both sides are shuffled on (topic,
    salt), as one topic may carry most of the messages.
    """
    if "topic" not in notifications.columns:
        notifications = notifications.withColumn("topic", F.lit(topic))
    if not isinstance(subscriptions, DataFrame):
        return notifications.withColumn(
            "queue", F.explode(subscribed_queues(F.col("topic"), subscriptions))
        )
    subscriptions = subscriptions.select("topic", "queue").distinct()
    if subscriptions.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        return notifications.join(F.broadcast(subscriptions), "topic")
    salted = notifications.withColumn(
        "_salt", F.pmod(F.xxhash64("uid", "Bucket", "Key"), F.lit(SALTS)).cast("int")
    )
    copies = subscriptions.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    return salted.join(copies, ["topic", "_salt"]).drop("_salt")
