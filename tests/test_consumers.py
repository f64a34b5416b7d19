"""Queues as consumers of their own: only the failing queue retries; a crash replays a batch alike."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from docflow.operators import lookup
from docflow.plans import stages
from docflow.sources.notifications import publish
from docflow.streaming import consumers
from docflow.streaming.runner import RetryPolicy

T0 = datetime(2024, 5, 1, tzinfo=timezone.utc)
POLICIES = {"file-stream-text": RetryPolicy("exponential", 2000), "file-stream-images": RetryPolicy("linear")}


@pytest.fixture()
def world(spark, tmp_path):
    docs = [(f"u{i}", "b", f"k{i}.pdf", f"page one of {i}\fpage two" if i % 2 else f"text {i}") for i in range(8)]
    objects = spark.createDataFrame(docs, "uid string, Bucket string, Key string, text string")
    publish(objects.select("uid", "Bucket", "Key").repartition(2), str(tmp_path / "inbox"))
    return objects, str(tmp_path)


def _log(spark, out, queue):
    rows = spark.read.parquet(consumers.deliveries_dir(out, queue)).where("batch_id >= 0")
    return sorted((r.uid, r.attempt, r.kind) for r in rows.collect())


def test_only_the_failing_queue_comes_again(spark, world):
    objects, root = world
    inbox, out, cp = f"{root}/inbox", f"{root}/out", f"{root}/cp"
    text, preview = stages.registered(["text", "previews"])
    every = lookup.table_fetcher(objects, "text")
    lagging = lookup.table_fetcher(objects.where(~F.col("uid").isin("u2", "u5")), "text")
    for at, fetch in ((T0, lagging), (T0 + timedelta(minutes=2), every)):
        consumers.consume(spark, inbox, out, cp, text, every, now=at).awaitTermination()
        consumers.consume(spark, inbox, out, cp, preview, fetch, now=at).awaitTermination()
        consumers.redeliver(spark, out, inbox, cp, POLICIES, clock=at + timedelta(minutes=1)).awaitTermination()
    assert _log(spark, out, "file-stream-text") == [(f"u{i}", 1, "ok") for i in range(8)]
    previews = _log(spark, out, "file-stream-images")
    assert [r for r in previews if r[0] in ("u2", "u5")] == [("u2", 1, "failed"), ("u2", 2, "ok"), ("u5", 1, "failed"), ("u5", 2, "ok")]
    assert len(previews) == 10
    steps = spark.read.parquet(f"{out}/visibility").where("step = 'failed'").collect()
    # The previews' own policy: linear, one second for the first attempt.
    assert {(r.uid, (r.visible_at - r.at).total_seconds()) for r in steps} == {("u2", 1.0), ("u5", 1.0)}
    redelivered = spark.read.json(consumers.redeliveries_dir(inbox, "file-stream-text"))
    assert redelivered.count() == 0


def test_a_crash_replays_the_batch_alike(spark, world):
    objects, root = world
    inbox, cp = f"{root}/inbox", f"{root}/cp"
    (text,) = stages.registered(["text"])
    every = lookup.table_fetcher(objects, "text")
    calls = []

    def breaks_once(targets):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        return every(targets)

    with pytest.raises(Exception, match="executor lost"):
        consumers.consume(spark, inbox, f"{root}/out", cp, text, breaks_once, now=T0).awaitTermination()
    consumers.consume(spark, inbox, f"{root}/out", cp, text, breaks_once, now=T0).awaitTermination()
    consumers.consume(spark, inbox, f"{root}/clean", f"{root}/cp2", text, every, now=T0).awaitTermination()
    assert _log(spark, f"{root}/out", "file-stream-text") == _log(spark, f"{root}/clean", "file-stream-text")
    outputs = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out/stage_text").drop("batch_id").collect())
    clean = sorted(tuple(r) for r in spark.read.parquet(f"{root}/clean/stage_text").drop("batch_id").collect())
    assert outputs == clean and len(outputs) == 8
