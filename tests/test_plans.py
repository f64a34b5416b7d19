"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.operators.lookup import table_fetcher
from docflow.plans import stages
from docflow.plans.queries import QUERIES
from docflow.sources.objects import save_partitioned
from docflow.sources.sinks import read_batches, write_batch


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def read_schemas(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


@pytest.mark.parametrize(
    "name",
    [
        "extract_text", "page_text", "page_stats", "build_notification", "decode_notification",
        "output_keys", "json_field", "quarantine", "fan_out", "preview_manifest",
        "previews_rendered", "sticky_success",
    ],
)
def test_no_shuffle(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("extract_text", ["doc_id:bigint,text:string"]),
        ("first_n_pages", ["conv_id:bigint,turn:bigint,text:string"]),
        ("json_field", ["event_id:bigint,props:string"]),
        ("build_notification", ["doc_id:bigint,source:string"]),
        ("missing_objects", ["doc_id:bigint,source:string", "doc_id:bigint,lang:string,source:string"]),
    ],
)
def test_columns_read(spark, sf_dir, name, columns):
    assert read_schemas(plan_of(QUERIES[name](spark, sf_dir))) == columns


def test_page_limit_runs_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["assemble_pages"](spark, sf_dir))
    lines = plan.splitlines()
    exchange = [i for i, line in enumerate(lines) if "Exchange" in line]
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    assert len(exchange) == 1 and limits[-1] > exchange[0] > limits[0]


def test_filters_reach_the_scan(spark, sf_dir):
    assert "Not(EqualTo(lang,fr))" in plan_of(QUERIES["fetch_objects"](spark, sf_dir))


@pytest.mark.parametrize("name", ["extract_text", "page_text", "sticky_success", "previews_rendered"])
def test_text_is_split_once(spark, sf_dir, name):
    assert plan_of(QUERIES[name](spark, sf_dir)).count("split(") == 1


@pytest.mark.parametrize("name", ["page_stats", "output_keys", "preview_manifest"])
def test_pages_are_counted_once_and_without_splitting(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "split(" not in plan and plan.count("replace(text") == 1


def test_bodies_are_parsed_once(spark, sf_dir):
    plan = plan_of(QUERIES["decode_notification"](spark, sf_dir))
    assert plan.count("from_json") == 2


def test_shared_work_of_stages_is_done_once(spark, sf_dir):
    plan = plan_of(QUERIES["run_stages"](spark, sf_dir))
    assert "from_json" not in plan and "split(" not in plan and "documents.parquet" not in plan


def test_only_parts_of_a_batch_are_read(spark, tmp_path):
    rows = [("b", f"k{i}", f"text {i}") for i in range(200)]
    objects = spark.createDataFrame(rows, "Bucket string, Key string, content string")
    save_partitioned(objects, f"{tmp_path}/objects", 16)
    fetch = table_fetcher(lambda: spark.read.parquet(f"{tmp_path}/objects"), parts=16)
    asked = spark.createDataFrame([("u", "b", "k7"), ("v", "b", "none")], "uid string, Bucket string, Key string")
    found = fetch(asked)
    assert [(r.Key, r.content) for r in found.collect()] == [("k7", "text 7")]
    assert re.search(r"PartitionFilters: \[object_part#\d+ (IN|=)|PartitionFilters: \[.*object_part", plan_of(found))


def test_rewritten_outputs_do_not_move_the_others(spark, tmp_path):
    path = f"{tmp_path}/out"
    rows = spark.range(3000).select(
        F.lit("b").alias("Bucket"), F.concat(F.lit("k"), "id").alias("output_key"), F.repeat(F.lit("x"), 500).alias("text")
    )
    write_batch(rows, path, 0)
    write_batch(rows.where("output_key IN ('k1', 'k2')"), path, 1)
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType())])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = read_batches(spark, path, schema, ["Bucket", "output_key"])
        assert kept.count() == 3000
        plan = plan_of(kept)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan.split(
            "InMemoryRelation")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("name", QUERIES)
def test_no_cartesian_product(spark, sf_dir, name):
    if not name.startswith("stream_"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_documents_of_one_file_are_cut_in_many_tasks(spark, tmp_path):
    rows = [(f"u{k}", "b", f"k{k}", f"line {k}\n" * 90) for k in range(2000)]
    made = spark.createDataFrame(rows, "uid string, Bucket string, Key string, text string")
    made.coalesce(1).write.parquet(f"{tmp_path}/objects")
    store = spark.read.parquet(f"{tmp_path}/objects")
    targets = F.broadcast(store.select("uid", "Bucket", "Key"))
    prepared = stages.prepare(targets, table_fetcher(store, "text"))
    # Partitions as they are dealt out, before small ones are joined.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = prepared.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks > 1
    assert prepared.count() == 2000
