"""Notification stream to stage outputs.

Every table below the output folder is written under ``batch_id=<id>`` in overwrite
mode. A batch is acknowledged by the checkpoint once all its writes are done; if it
is run again it replaces what it wrote before. Only a document that was missing the
first time and is there the second keeps its ledger row: it is delivered once more
and gives the same outputs.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docflow.functions.envelope import attempt_of, topic_of
from docflow.functions.retry import STEEP_TEXT_MS, STRATEGIES
from docflow.operators.fanout import subscribed_queues
from docflow.operators.ledger import due, push_back, schedule
from docflow.operators.lookup import Fetcher, broadcast_if_small, row_bytes
from docflow.operators.notifications import (
    accepted,
    decode_bodies,
    delivery_id,
    distinct_targets,
    quarantined,
)
from docflow.operators.pages import Extractor
from docflow.plans.stages import (
    Stage,
    failed,
    pages_needed,
    prepare,
    readable,
    registered,
    run_stages,
)
from docflow.schemas import (
    DEFAULT_VISIBILITY_SECONDS,
    REDELIVERED,
    RETRY_LEDGER,
    STAGE_SUMMARY,
    TOPIC,
)
from docflow.session import scratch_dir
from docflow.sources.notifications import publish
from docflow.sources.sinks import put_objects, read_or_empty, write_batch
from docflow.streaming.dedup import dedup_stream

QUARANTINE_DIR = "quarantine"
LEDGER_DIR = "retry_ledger"
REDELIVERED_DIR = "redelivered"
RECEIPTS_DIR = "stored"
SUMMARY_DIR = "summary"


DEFAULT_VISIBILITY = f"{DEFAULT_VISIBILITY_SECONDS} seconds"


@dataclass(frozen=True)
class RetryPolicy:
    """Delay curve of failed messages; ``base_ms`` matters for the exponential one."""

    strategy: str = "exponential"
    base_ms: int = STEEP_TEXT_MS
    reset: bool = True

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            warnings.warn(f"no retry strategy {self.strategy!r}: delays are linear", stacklevel=2)

    def options(self) -> dict:
        return {"base_ms": self.base_ms, "reset": self.reset}


@dataclass(frozen=True)
class StreamConfig:
    """Settings of one run.

    ``poll_interval`` None means: read what is there, then stop. ``dedup_within``
    (say ``DEFAULT_VISIBILITY``) keeps state to drop copies that come in a later
    batch; without it they are processed again and replace equal outputs. Bodies of
    outputs are also stored as objects below the URI ``put``, if it is given; with
    ``packed`` many of them share a file (see ``sources.packs``). With
    ``subscriptions``, pairs of topic and queue, a stage gets the messages of the
    topics its queue is subscribed to; without them every stage gets all.
    """

    name: str = "docflow"
    stages: tuple[str, ...] = ("text", "previews")
    poll_interval: str | None = None
    dedup_within: str | None = None
    retry: RetryPolicy = RetryPolicy()
    put: str | None = None
    packed: bool = False
    subscriptions: tuple[tuple[str, str], ...] | None = None


def stage_dir(out: str, stage: str) -> str:
    return f"{out}/stage_{stage}"


def process_batch(
    decoded: DataFrame,
    batch_id: int,
    out: str,
    fetch: Fetcher,
    stages: Sequence[Stage],
    extract: Extractor | None = None,
    retry: RetryPolicy = RetryPolicy(),
    now: datetime | None = None,
    put: str | None = None,
    packed: bool = False,
) -> None:
    """Look up, run every stage and write all outputs of one batch of decoded bodies.

    With a ``queues`` column a stage gets the documents of messages to its queue.
    """
    now = now or datetime.now(timezone.utc)
    decoded = decoded.persist()
    prepared = None
    try:
        rows, bad, size = decoded.agg(
            F.count(F.lit(1)), F.count("reason"), row_bytes(accepted(decoded))
        ).first()
        if bad:
            write_batch(quarantined(decoded).drop("queues"), f"{out}/{QUARANTINE_DIR}", batch_id)
        if rows == bad:
            return
        spark = decoded.sparkSession
        targets = broadcast_if_small(distinct_targets(accepted(decoded)), size)
        # Each stage and the ledger read this; it is looked up and cut only once.
        prepared = prepare(targets, fetch, extract, pages_needed(stages)).persist()
        failures = failed(targets, prepared)
        n_failed = failures.count()
        counts = []
        for name, outputs in run_stages(readable(prepared), stages).items():
            stage = next(s for s in stages if s.name == name)
            # Counted while written: the outputs are not read again for their totals.
            seen = Observation(f"{name}-{batch_id}")
            counted = outputs.observe(
                seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("content_length"), F.lit(0)).alias("size")
            )
            write_batch(counted, stage_dir(out, name), batch_id)
            done = spark.read.schema(outputs.schema).parquet(f"{stage_dir(out, name)}/batch_id={batch_id}")
            stored = 0
            if put and stage.body:
                # Reading the receipts writes the objects; a replay writes them again alike.
                receipts = f"{out}/{RECEIPTS_DIR}_{name}"
                write_batch(put_objects(done, put, stage.body, packed=packed), receipts, batch_id)
                stored = spark.read.parquet(f"{receipts}/batch_id={batch_id}").count()
            n, size = seen.get["n"], seen.get["size"]
            counts.append((name, rows, bad, n_failed, n, size or 0, stored))
        if n_failed:
            record_failures(failures, batch_id, out, retry, now)
        summary = T.StructType(STAGE_SUMMARY.fields[:-1])
        write_batch(spark.createDataFrame(counts, summary).coalesce(1), f"{out}/{SUMMARY_DIR}", batch_id)
    finally:
        if prepared is not None:
            prepared.unpersist()
        decoded.unpersist()


def record_failures(
    failures: DataFrame, batch_id: int, out: str, retry: RetryPolicy, now: datetime
) -> None:
    """Move failed messages to the ledger, one attempt further than before.

    Attempts are counted by message: another message about the same object starts
    from one. Only batches before this one count, so a replay gives the same attempts,
    and only the ledger's rows of these messages are aggregated.
    """
    path = f"{out}/{LEDGER_DIR}"
    failures = failures.withColumn("_id", delivery_id())
    ids = failures.select("_id").distinct()
    size = ids.agg(row_bytes(ids)).first()[0]
    before = (
        read_or_empty(failures.sparkSession, path, RETRY_LEDGER)
        .where(F.col("batch_id") < batch_id)
        .select(delivery_id().alias("_id"), "attempt")
        .join(broadcast_if_small(ids, size), "_id", "left_semi")
        .groupBy("_id")
        .agg(F.max("attempt").alias("_tried"))
    )
    rows = failures.join(before, "_id", "left").select(
        "uid",
        "Bucket",
        "Key",
        (F.coalesce("_tried", F.lit(0).cast("bigint")) + 1).alias("attempt"),
        "reason",
        F.lit(now).alias("last_attempt_at"),
    )
    planned = schedule(rows, "last_attempt_at", retry.strategy, **retry.options())
    write_batch(planned, path, batch_id)


def delay(spark: SparkSession, out: str, messages: DataFrame, seconds: int) -> None:
    """Keep failed messages, named by their ``uid``, back for ``seconds`` after their last attempt."""
    ledger = latest_attempts(read_or_empty(spark, f"{out}/{LEDGER_DIR}", RETRY_LEDGER))
    asked = ledger.join(messages.select("uid").distinct(), "uid", "left_semi")
    columns = [c for c in RETRY_LEDGER.fieldNames() if c != "batch_id"]
    rows = push_back(asked, seconds).select(*columns)
    rows.write.mode("append").parquet(f"{out}/{LEDGER_DIR}/batch_id=-1")


def latest_attempts(ledger: DataFrame) -> DataFrame:
    """The last entry of each message; of one attempt, that with the latest time."""
    columns = [c for c in RETRY_LEDGER.fieldNames() if c != "batch_id"]
    order = F.struct("attempt", "next_attempt_at")
    last = ledger.groupBy(delivery_id().alias("_id")).agg(F.max_by(F.struct(*columns), order).alias("_last"))
    return last.select("_last.*")


def start(
    bodies: DataFrame,
    fetch: Fetcher,
    out: str,
    checkpoint: str,
    config: StreamConfig = StreamConfig(),
    extract: Extractor | None = None,
) -> StreamingQuery:
    """Run stages over a stream of bodies (``Body, received_at``)."""
    stages = registered(config.stages)
    decoded = decode_bodies(bodies)
    if config.dedup_within:
        # A redelivery is not a copy of the delivery that failed. Bodies that give
        # no message have no identity but themselves.
        message_id = F.concat_ws("#", delivery_id(), attempt_of("Body"))
        decoded = decoded.withColumn(
            "_id", F.when(F.col("reason").isNull(), message_id).otherwise(F.col("Body"))
        )
        decoded = dedup_stream(decoded, "_id", "received_at", config.dedup_within).drop("_id")

    if config.subscriptions is not None:
        topic = F.coalesce(topic_of("Body"), F.lit(TOPIC))
        decoded = decoded.withColumn("queues", subscribed_queues(topic, config.subscriptions))
    # Only a body that could not be read is needed any further.
    decoded = decoded.withColumn("Body", F.when(F.col("reason").isNotNull(), F.col("Body")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(
            batch, batch_id, out, fetch, stages, extract, config.retry, put=config.put, packed=config.packed
        )

    writer = (
        decoded.drop("received_at")
        .writeStream.queryName(f"{config.name}-{uuid.uuid4().hex[:8]}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    if config.poll_interval:
        return writer.trigger(processingTime=config.poll_interval).start()
    return writer.trigger(availableNow=True).start()


def redeliver(spark: SparkSession, out: str, inbox: str, now: datetime | None = None) -> None:
    """Publish the ledger's due messages again, each failed attempt once.

    The due rows are fixed by a checkpoint first, so what is marked is what was
    published. A crash in between publishes them twice, which does no harm.
    """
    now = now or datetime.now(timezone.utc)
    run_id = uuid.uuid4().hex
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "redeliver"))
    ledger = read_or_empty(spark, f"{out}/{LEDGER_DIR}", RETRY_LEDGER)
    done = read_or_empty(spark, f"{out}/{REDELIVERED_DIR}", REDELIVERED)
    sent = done.select(delivery_id().alias("_id"), "attempt")
    ready = due(latest_attempts(ledger), now).withColumn("_id", delivery_id())
    ready = ready.join(sent, ["_id", "attempt"], "left_anti")
    ready = ready.checkpoint()
    publish(ready.select("uid", "Bucket", "Key", "attempt"), inbox)
    ready.select("uid", "Bucket", "Key", "attempt").write.mode("overwrite").parquet(
        f"{out}/{REDELIVERED_DIR}/run_id={run_id}"
    )
