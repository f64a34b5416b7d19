from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from docflow.operators.lookup import table_fetcher
from docflow.operators.metrics import observed, run_summary
from docflow.operators.notifications import decode_bodies
from docflow.operators.pages import extract_text, line_extractor, python_extractor
from docflow.plans import fixtures as fx
from docflow.plans import stages
from docflow.schemas import DOCUMENT_TEXT, PREVIEW_PAGES, QUARANTINE, RETRY_LEDGER
from docflow.sources.notifications import publish, stream_bodies
from docflow.sources.sinks import read_batches, read_or_empty
from docflow.streaming import runner
from docflow.streaming.dedup import dedup_stream

OBJECTS = [(f"k{i}", "\n".join(f"{i}.{line}" for line in range(i * 7 % 60 + 1))) for i in range(40)]


@pytest.fixture
def objects(spark):
    rows = [("b", k, t) for k, t in OBJECTS]
    return spark.createDataFrame(rows, "Bucket string, Key string, content string")


def send(spark, inbox, names):
    rows = [(f"uid-{n}", "b", n) for n in names]
    publish(spark.createDataFrame(rows, "uid string, Bucket string, Key string").coalesce(1), inbox)


def run(spark, work, objects, extract=None, **config):
    query = runner.start(
        stream_bodies(spark, f"{work}/inbox", 1),
        table_fetcher(objects),
        f"{work}/out",
        f"{work}/checkpoint",
        runner.StreamConfig(**config),
        extract,
    )
    query.awaitTermination()
    return [p for p in query.recentProgress if p.numInputRows > 0]


def texts(spark, work):
    rows = read_batches(spark, runner.stage_dir(f"{work}/out", "text"), DOCUMENT_TEXT, ["Bucket", "output_key"])
    return {r.Key: r.text for r in rows.collect()}


def files(path):
    return sorted(p.name for p in path.rglob("*.parquet"))


def expected(names):
    contents = dict(OBJECTS)
    out = {}
    for name in names:
        lines = contents[name].split("\n")[:50]
        out[name] = "".join(" ".join(lines[i : i + 5]) for i in range(0, len(lines), 5))
    return out


def test_batches_rerun_and_copies(spark, tmp_path, objects):
    inbox = f"{tmp_path}/inbox"
    names = [k for k, _ in OBJECTS]
    send(spark, inbox, names[:15])
    send(spark, inbox, names[10:30] + ["k12"] * 100)
    send(spark, inbox, names[30:])
    assert len(run(spark, tmp_path, objects)) == 3
    assert texts(spark, tmp_path) == expected(names)
    previews = read_batches(
        spark, runner.stage_dir(f"{tmp_path}/out", "previews"), PREVIEW_PAGES, ["Bucket", "output_key"]
    )
    want = sum(min(10, -(-len(t.split("\n")) // 5)) for _, t in OBJECTS)
    assert previews.count() == want
    assert previews.select("output_key").distinct().count() == want
    before = files(tmp_path / "out")
    assert run(spark, tmp_path, objects) == []
    assert files(tmp_path / "out") == before


def test_state_drops_copies_of_earlier_batches(spark, tmp_path, objects):
    inbox = f"{tmp_path}/inbox"
    send(spark, inbox, ["k1", "k2", "k1"])
    send(spark, inbox, ["k2", "k3"])
    run(spark, tmp_path, objects, stages=("text",), dedup_within="10 minutes")
    rows = read_or_empty(spark, runner.stage_dir(f"{tmp_path}/out", "text"), DOCUMENT_TEXT)
    assert sorted((r.Key, r.batch_id) for r in rows.collect()) == [("k1", 0), ("k2", 0), ("k3", 1)]


@pytest.mark.parametrize("within", [None, "10 minutes"])
def test_bad_bodies_go_to_quarantine(spark, tmp_path, objects, within):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lines = [{"Body": "junk"}, {"Body": '{"Message":"oops"}'}, {"Body": "null"}]
    (inbox / "a.json").write_text("\n".join(map(json.dumps, lines)))
    send(spark, str(inbox), ["k1"])
    run(spark, tmp_path, objects, stages=("text",), dedup_within=within)
    rows = read_or_empty(spark, f"{tmp_path}/out/{runner.QUARANTINE_DIR}", QUARANTINE).collect()
    assert {(r.Body, r.reason) for r in rows} == {
        ("junk", "body is not JSON"),
        ('{"Message":"oops"}', "message is not JSON"),
        ("null", "body has no Message"),
    }
    assert texts(spark, tmp_path) == expected(["k1"])


@pytest.mark.parametrize("within", [None, "10 minutes"])
def test_missing_object_comes_back_until_it_is_there(spark, tmp_path, objects, within):
    out, inbox = f"{tmp_path}/out", f"{tmp_path}/inbox"
    config = {"stages": ("text",), "retry": runner.RetryPolicy("linear"), "dedup_within": within}
    partial = objects.where("Key <> 'k5'")
    send(spark, inbox, ["k4", "k5"])
    run(spark, tmp_path, partial, **config)

    def attempts():
        rows = read_or_empty(spark, f"{out}/{runner.LEDGER_DIR}", RETRY_LEDGER)
        return sorted((r.Key, r.attempt, r.reason) for r in rows.collect())

    assert attempts() == [("k5", 1, "object is missing")]
    now = datetime.now(timezone.utc)
    runner.redeliver(spark, out, inbox, now - timedelta(minutes=1))
    assert run(spark, tmp_path, partial, **config) == []

    runner.redeliver(spark, out, inbox, now + timedelta(minutes=1))
    assert len(run(spark, tmp_path, partial, **config)) == 1
    assert [a[1] for a in attempts()] == [1, 2]

    runner.redeliver(spark, out, inbox, now + timedelta(minutes=2))
    assert len(run(spark, tmp_path, objects, **config)) == 1
    assert [a[1] for a in attempts()] == [1, 2]
    assert texts(spark, tmp_path) == expected(["k4", "k5"])

    runner.redeliver(spark, out, inbox, now + timedelta(minutes=3))
    assert run(spark, tmp_path, objects, **config) == []


def test_objects_stored_while_the_stream_runs(spark, tmp_path, objects):
    table = f"{tmp_path}/objects"
    objects.where("Key = 'k1'").write.parquet(table)
    (tmp_path / "inbox").mkdir()
    query = runner.start(
        stream_bodies(spark, f"{tmp_path}/inbox", 1),
        table_fetcher(lambda: spark.read.parquet(table)),
        f"{tmp_path}/out",
        f"{tmp_path}/checkpoint",
        runner.StreamConfig(stages=("text",), poll_interval="0 seconds"),
    )
    try:
        send(spark, f"{tmp_path}/inbox", ["k1"])
        query.processAllAvailable()
        objects.where("Key = 'k2'").write.mode("append").parquet(table)
        send(spark, f"{tmp_path}/inbox", ["k2"])
        query.processAllAvailable()
    finally:
        query.stop()
    assert texts(spark, tmp_path) == expected(["k1", "k2"])


def test_unreadable_document_goes_to_the_ledger(spark, tmp_path, objects):
    def open_document(content):
        if "7." in content:
            raise ValueError("unreadable")
        return 1, [[content]]

    send(spark, f"{tmp_path}/inbox", ["k1", "k7"])
    run(spark, tmp_path, objects, python_extractor(open_document), stages=("text",))
    assert set(texts(spark, tmp_path)) == {"k1"}
    rows = read_or_empty(spark, f"{tmp_path}/out/{runner.LEDGER_DIR}", RETRY_LEDGER).collect()
    assert [(r.Key, r.reason) for r in rows] == [("k7", "ValueError: unreadable")]


def test_replayed_batch_replaces_what_it_wrote(spark, tmp_path, objects):
    bodies = spark.createDataFrame(
        [(json.dumps({"Message": json.dumps({"uid": n, "Bucket": "b", "Key": n})}),) for n in ("k1", "none")],
        "Body string",
    )
    for _ in range(2):
        runner.process_batch(
            decode_bodies(bodies), 3, f"{tmp_path}/out", table_fetcher(objects), stages.registered()
        )
    rows = read_or_empty(spark, runner.stage_dir(f"{tmp_path}/out", "text"), DOCUMENT_TEXT)
    assert [(r.Key, r.batch_id) for r in rows.collect()] == [("k1", 3)]
    ledger = read_or_empty(spark, f"{tmp_path}/out/{runner.LEDGER_DIR}", RETRY_LEDGER)
    assert [(r.Key, r.attempt) for r in ledger.collect()] == [("none", 1)]


def test_own_stage(spark, tmp_path, objects):
    def count_words(docs):
        words = F.size(F.split(F.array_join("page_texts", " "), " "))
        return docs.select(
            "Bucket", "Key", F.concat(F.lit("words/"), "Key").alias("output_key"),
            words.alias("words"), F.lit(0).cast("bigint").alias("content_length"),
        )

    stages.register(stages.Stage("words", "file-stream-words", count_words))
    try:
        send(spark, f"{tmp_path}/inbox", ["k8", "k9"])
        run(spark, tmp_path, objects, stages=("text", "words"))
        rows = spark.read.parquet(runner.stage_dir(f"{tmp_path}/out", "words")).collect()
        # Without a cap of its own the stage sees all pages, the text stage ten.
        assert {r.Key: r.words for r in rows} == {"k8": 57, "k9": 4}
        assert texts(spark, tmp_path) == expected(["k8", "k9"])
    finally:
        stages._REGISTRY.pop("words")


def test_unknown_stage():
    with pytest.raises(KeyError, match="nope"):
        stages.registered(["text", "nope"])


@pytest.mark.parametrize("salts", [1, 4])
def test_dedup_stream_with_a_hot_message(spark, tmp_path, salts):
    for _ in range(3):
        rows = spark.range(300).select(F.when(F.col("id") < 100, -1).otherwise(F.col("id")).alias("id"))
        rows.repartition(4).write.mode("append").parquet(f"{tmp_path}/in")
    stream = (
        spark.readStream.schema("id long")
        .option("maxFilesPerTrigger", 5)
        .parquet(f"{tmp_path}/in")
        .withColumn("at", F.current_timestamp())
    )
    query = (
        dedup_stream(stream, "id", "at", "1 hour", salts)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    got = sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [-1, *range(100, 300)]


def test_batch_equals_stream(spark, tmp_path, sf_dir):
    publish(fx.notifications(spark, sf_dir).repartition(3), f"{tmp_path}/inbox")
    run(spark, tmp_path, fx.objects(spark, sf_dir).withColumnRenamed("text", "content"), stages=("text",))
    streamed = spark.read.parquet(runner.stage_dir(f"{tmp_path}/out", "text")).select("Key", "text")
    docs = fx.objects(spark, sf_dir).select("Key", "text")
    batch = extract_text(line_extractor("text")(docs).drop("text")).select("Key", "text")
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_observed_totals(spark, objects):
    docs = extract_text(line_extractor()(objects).drop("content"))
    rows, observation = observed(docs)
    assert rows.count() == len(OBJECTS)
    assert observation.get == run_summary(docs).first().asDict()
