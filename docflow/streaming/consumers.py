"""Each queue a consumer of its own: stream, checkpoint, delivery log and retry policy.

A consumer reads the topic's inbox and its queue's own redelivery inbox, runs
its one stage and writes its outputs; then it writes, for every message of the
batch, the outcome of this delivery to its own log (``deliveries_<queue>``).
Its checkpoint acknowledges the batch once both are written, so a queue's
success or failure never touches another queue's messages.

A delivery fails in a queue when the object is missing or unreadable there, or
when the stage gives nothing for a readable document that has pages (say, no
page of it renders). ``redeliver`` runs the delivery logs of all queues
through the visibility timers (``visibility``), each queue with its own retry
policy, and publishes each message that came due again, one attempt further,
into its queue's redelivery inbox only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docflow.functions.envelope import attempt_of, topic_of
from docflow.operators.fanout import subscribed_queues
from docflow.operators.lookup import Fetcher
from docflow.operators.notifications import accepted, decode_bodies, delivery_id, distinct_targets
from docflow.operators.pages import Extractor
from docflow.plans.stages import Stage, failed, prepare, readable
from docflow.schemas import TOPIC
from docflow.sources.notifications import publish, stream_bodies
from docflow.sources.sinks import write_batch
from docflow.streaming import visibility
from docflow.streaming.runner import RetryPolicy, stage_dir

DELIVERIES = T.StructType(
    [
        T.StructField("queue", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("Bucket", T.StringType()),
        T.StructField("Key", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)
NO_OUTPUT = "stage gave no output"


def deliveries_dir(out: str, queue: str) -> str:
    return f"{out}/deliveries_{queue}"


def redeliveries_dir(inbox: str, queue: str) -> str:
    return f"{inbox}_redeliver/{queue}"


def outcomes(messages: DataFrame, prepared: DataFrame, outputs: DataFrame, queue: str, now: datetime) -> DataFrame:
    """One row per message: ``ok``, or ``failed`` with the reason, at ``now``."""
    targets = messages.select("uid", "Bucket", "Key")
    gone = failed(targets, prepared).select("Bucket", "Key", "reason")
    with_pages = readable(prepared).where(F.col("n_pages") >= 1).select("Bucket", "Key")
    empty = with_pages.join(outputs.select("Bucket", "Key").distinct(), ["Bucket", "Key"], "left_anti")
    reasons = gone.unionByName(empty.withColumn("reason", F.lit(NO_OUTPUT)))
    reasons = reasons.groupBy("Bucket", "Key").agg(F.min("reason").alias("reason"))
    judged = messages.join(reasons, ["Bucket", "Key"], "left")
    at = F.timestamp_millis(F.lit(int(now.timestamp() * 1000)))
    return judged.select(
        F.lit(queue).alias("queue"),
        delivery_id().alias("uid"),
        "Bucket",
        "Key",
        "attempt",
        F.when(F.col("reason").isNull(), "ok").otherwise("failed").alias("kind"),
        "reason",
        at.alias("at"),
    )


def deliver_batch(
    decoded: DataFrame,
    batch_id: int,
    out: str,
    stage: Stage,
    fetch: Fetcher,
    extract: Extractor | None = None,
    now: datetime | None = None,
) -> None:
    """Run one queue's stage over one batch and log the outcome of each message."""
    now = now or datetime.now(timezone.utc)
    messages = accepted(decoded)
    if "queues" in messages.columns:
        messages = messages.where(F.array_contains("queues", stage.queue)).drop("queues")
    messages = messages.persist()
    prepared = None
    try:
        if messages.isEmpty():
            return
        prepared = prepare(distinct_targets(messages), fetch, extract, stage.cap).persist()
        write_batch(stage.process(readable(prepared)), stage_dir(out, stage.name), batch_id)
        done = decoded.sparkSession.read.parquet(f"{stage_dir(out, stage.name)}/batch_id={batch_id}")
        log = outcomes(messages, prepared, done, stage.queue, now)
        write_batch(log, deliveries_dir(out, stage.queue), batch_id)
    finally:
        if prepared is not None:
            prepared.unpersist()
        messages.unpersist()


def consume(
    spark: SparkSession,
    inbox: str,
    out: str,
    checkpoint: str,
    stage: Stage,
    fetch: Fetcher,
    subscriptions: Sequence[tuple[str, str]] | None = None,
    extract: Extractor | None = None,
    max_files_per_trigger: int | None = None,
    poll_interval: str | None = None,
    now: datetime | None = None,
) -> StreamingQuery:
    """Start the consumer of ``stage.queue``: the topic's inbox and its own redeliveries.

    Outcomes are logged at the time of their batch, or at ``now`` if given (a
    replay of recorded traffic).
    """
    own = redeliveries_dir(inbox, stage.queue)
    spark.createDataFrame([], "Body string").write.mode("append").json(own)
    bodies = stream_bodies(spark, inbox, max_files_per_trigger).unionByName(
        stream_bodies(spark, own, max_files_per_trigger)
    )
    decoded = decode_bodies(bodies.select("Body"))
    decoded = decoded.withColumn("attempt", F.coalesce(attempt_of("Body").cast("long"), F.lit(1).cast("long")))
    if subscriptions is not None:
        topic = F.coalesce(topic_of("Body"), F.lit(TOPIC))
        decoded = decoded.withColumn("queues", subscribed_queues(topic, subscriptions))

    def handle(batch: DataFrame, batch_id: int) -> None:
        deliver_batch(batch, batch_id, out, stage, fetch, extract, now)

    writer = decoded.writeStream.option("checkpointLocation", f"{checkpoint}/{stage.queue}").foreachBatch(handle)
    if poll_interval:
        return writer.trigger(processingTime=poll_interval).start()
    return writer.trigger(availableNow=True).start()


def redeliver(
    spark: SparkSession,
    out: str,
    inbox: str,
    checkpoint: str,
    policies: dict[str, RetryPolicy],
    clock: datetime | None = None,
) -> StreamingQuery:
    """Publish each message that came due again into its own queue's redelivery inbox.

    Reads the delivery logs of the queues of ``policies`` as streams. ``clock``, if
    given, is one more outcome of no message at that time: it moves the timers'
    time on where no delivery comes for a while.
    """
    logs = []
    for queue in policies:
        path = deliveries_dir(out, queue)
        spark.createDataFrame([], DELIVERIES).write.mode("append").parquet(f"{path}/batch_id=-1")
        logged = T.StructType([*DELIVERIES.fields, T.StructField("batch_id", T.LongType())])
        logs.append(spark.readStream.schema(logged).parquet(path))
    stream = logs[0]
    for more in logs[1:]:
        stream = stream.unionByName(more)
    rows = stream.select(
        "queue",
        "uid",
        "at",
        "kind",
        F.lit(None).cast("long").alias("seconds"),
        F.col("attempt").alias("seq"),
        "Bucket",
        "Key",
    )
    if clock is not None:
        schema = T.StructType([*visibility.OUTCOMES.fields, DELIVERIES["Bucket"], DELIVERIES["Key"]])
        tick = spark.createDataFrame([("", "", clock, "tick", None, 0, "", "")], schema)
        ticks = f"{out}/clock"
        tick.write.mode("append").parquet(ticks)
        rows = rows.unionByName(spark.readStream.schema(tick.schema).parquet(ticks))
    steps = visibility.visibility_steps(rows, policies, carry=("Bucket", "Key"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/visibility", batch_id)
        done = spark.read.parquet(f"{out}/visibility/batch_id={batch_id}").where("step = 'due'")
        for queue in policies:
            due = done.where(F.col("queue") == queue).select("uid", "Bucket", "Key", F.col("attempt").cast("long"))
            if not due.isEmpty():
                publish(due, redeliveries_dir(inbox, queue))

    return (
        steps.writeStream.option("checkpointLocation", f"{checkpoint}/redeliver")
        .foreachBatch(handle)
        .trigger(availableNow=True)
        .start()
    )
