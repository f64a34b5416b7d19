from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from docflow.functions.envelope import json_property
from docflow.operators.fanout import fan_out
from docflow.operators.notifications import (
    accepted,
    build_bodies,
    decode_bodies,
    dedup_notifications,
    distinct_targets,
    quarantined,
)

NOTE = {"uid": "u", "Bucket": "b", "Key": "k"}
COLUMNS = "uid string, Bucket string, Key string"


def body(message):
    return json.dumps({"Message": message})


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        (body(json.dumps(NOTE)), None),
        (body(json.dumps(NOTE))[:-1], "body is not JSON"),
        (body(json.dumps(NOTE))[:-5], "body is not JSON"),
        ("not json", "body is not JSON"),
        ("", "body is not JSON"),
        (body(json.dumps(NOTE)) + " x", "body is not JSON"),
        (body(json.dumps(NOTE)) + "," + body(json.dumps(NOTE)), "body is not JSON"),
        (body(json.dumps(NOTE)).replace('"Message"', "'Message'"), "body is not JSON"),
        (f"  {body(json.dumps(NOTE))}\n", None),
        (json.dumps({"Message": NOTE}), "Message is not a string"),
        ('{"Message":5}', "Message is not a string"),
        (body(json.dumps(NOTE) + "}"), "message is not JSON"),
        (None, "body is not JSON"),
        ("null", "body has no Message"),
        ("0", "body has no Message"),
        ('""', "body has no Message"),
        ("false", "body has no Message"),
        ("[1]", "body has no Message"),
        ('{"x":1}', "body has no Message"),
        ('{"Message":null}', "body has no Message"),
        ('{"Message":"oops"}', "message is not JSON"),
        (body("{}"), "message has no Key"),
        (body(json.dumps({"uid": "u", "Bucket": "b"})), "message has no Key"),
        (body(json.dumps({"uid": "u", "Key": "k"})), "message has no Bucket"),
        (body(json.dumps({"Bucket": "b", "Key": "k"})), None),
        (body(json.dumps({"uid": None, "Bucket": "b", "Key": "k"})), None),
        (body(json.dumps({"uid": 5, "Bucket": "b", "Key": "k"})), None),
        ('{"Message":"x","Message":' + json.dumps(json.dumps(NOTE)) + "}", None),
        (body('{"Key":"a","Key":"k","Bucket":"b"}'), None),
        (body(json.dumps({"Bucket": "b", "Key": ""})), "Key is no text or empty"),
        (body(json.dumps({"Bucket": "b", "Key": {"x": 1}})), "Key is no text or empty"),
        (body(json.dumps({"Bucket": "", "Key": "k"})), "Bucket is no text or empty"),
        (body(json.dumps({"Bucket": ["b"], "Key": "k"})), "Bucket is no text or empty"),
        (body(json.dumps({"Bucket": "b", "Key": "../../secret"})), "Key leaves the store"),
        (body(json.dumps({"Bucket": "b", "Key": "a/../../s"})), "Key leaves the store"),
        (body(json.dumps({"Bucket": "..", "Key": "k"})), "Key leaves the store"),
        (body(json.dumps({"Bucket": "b", "Key": "a..b/c"})), None),
    ],
)
def test_reasons(spark, text, reason):
    row = decode_bodies(spark.createDataFrame([(text,)], "Body string")).first()
    assert row.reason == reason
    assert row.Body == text


def test_split_loses_nothing(spark):
    texts = [body(json.dumps(NOTE)), "null", "x", body(json.dumps(NOTE))]
    decoded = decode_bodies(spark.createDataFrame([(t,) for t in texts], "Body string"))
    assert accepted(decoded).count() + quarantined(decoded).count() == len(texts)
    assert {r.Body for r in quarantined(decoded).collect()} == {"null", "x"}


def test_round_trip_with_odd_characters(spark):
    rows = [('a"b', "é\\", "x/y z.pdf"), ("ü\n", "b", "漢字.pdf")]
    sent = spark.createDataFrame(rows, COLUMNS)
    bodies = build_bodies(sent).select("Body")
    assert [json.loads(json.loads(r.Body)["Message"]) for r in bodies.collect()] == [
        dict(zip(("uid", "Bucket", "Key"), row)) for row in rows
    ]
    assert [tuple(r) for r in accepted(decode_bodies(bodies)).collect()] == rows


def test_json_property(spark):
    rows = [('{"k": 5}',), ('{"k": "x"}',), ("{}",), ("nope",), (None,)]
    df = spark.createDataFrame(rows, "props string")
    assert [r.k for r in df.select(json_property("props", "k", "int").alias("k")).collect()] == [
        5, None, None, None, None,
    ]


def test_dedup_keeps_one_of_each_message(spark):
    rows = [("u1", "b", "k1")] * 50 + [("u2", "b", "k2"), (None, "b", "k3"), (None, "b", "k4"), (None, "b", "k4")]
    got = dedup_notifications(spark.createDataFrame(rows, COLUMNS).repartition(5))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, [("u1", "b", "k1"), ("u2", "b", "k2"), (None, "b", "k3"), (None, "b", "k4")])
    )


def test_distinct_targets(spark):
    rows = [("u2", "b", "k"), ("u1", "b", "k"), ("u3", "b", "l")]
    got = distinct_targets(spark.createDataFrame(rows, COLUMNS)).collect()
    assert sorted(tuple(r) for r in got) == [("b", "k", "u1"), ("b", "l", "u3")]


SUBSCRIPTIONS = [("t", "q1"), ("t", "q2"), ("t", "q2"), ("other", "q3")]


@pytest.mark.parametrize("form", ["list", "table", "salted"])
def test_fan_out(spark, form):
    sent = spark.range(100).select(
        F.col("id").cast("string").alias("uid"),
        F.lit("b").alias("Bucket"),
        F.lit("k").alias("Key"),
        F.when(F.col("id") < 90, "t").when(F.col("id") < 95, "other").otherwise("none").alias("topic"),
    )
    subs = SUBSCRIPTIONS if form == "list" else spark.createDataFrame(SUBSCRIPTIONS, "topic string, queue string")
    got = fan_out(sent, subs, max_broadcast_rows=1 if form == "salted" else 100)
    assert sorted((r.queue, int(r.uid)) for r in got.collect()) == sorted(
        [(q, i) for q in ("q1", "q2") for i in range(90)] + [("q3", i) for i in range(90, 95)]
    )


def test_fan_out_defaults(spark):
    sent = spark.createDataFrame([("u", "b", "k")], COLUMNS)
    assert {r.queue for r in fan_out(sent).collect()} == {"file-stream-text", "file-stream-images"}
