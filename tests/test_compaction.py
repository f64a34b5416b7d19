"""Base plus deltas: equal to all batches, files read follow the deltas, a crash before the switch is harmless."""

from __future__ import annotations

from pyspark.sql import types as T

from docflow.sources import compaction
from docflow.sources.sinks import read_batches, write_batch

SCHEMA = T.StructType(
    [
        T.StructField("Bucket", T.StringType()),
        T.StructField("output_key", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
KEY = ["Bucket", "output_key"]


def _write(spark, path, batch, keys):
    rows = [("b", f"k{k}", f"text {k} of batch {batch}") for k in keys]
    write_batch(spark.createDataFrame(rows, "Bucket string, output_key string, text string"), path, batch)


def _rows(df):
    return sorted((r.Bucket, r.output_key, r.text) for r in df.collect())


def test_base_and_deltas(spark, tmp_path):
    path = str(tmp_path / "out")
    for batch, keys in enumerate([range(0, 50), range(40, 60), range(0, 5)]):
        _write(spark, path, batch, keys)
    assert compaction.read_current(spark, path, SCHEMA, KEY).count() == 60
    first = compaction.compact(spark, path, SCHEMA, KEY)
    assert (first.version, first.through) == (1, 2)
    assert compaction.compact(spark, path, SCHEMA, KEY) is None  # nothing new
    _write(spark, path, 3, range(55, 70))
    _write(spark, path, 4, [1, 2, 3])
    current = compaction.read_current(spark, path, SCHEMA, KEY)
    assert _rows(current) == _rows(read_batches(spark, path, SCHEMA, KEY))
    assert len(_rows(current)) == 70
    # Only the base and the batches after the merge are read: the scan of batches is pruned.
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "(batch_id#" in plan and " > 2)]" in plan
    assert any(compaction.BASES in f for f in current.inputFiles())


def test_crash_between_merge_and_switch(spark, tmp_path):
    path = str(tmp_path / "out")
    for batch, keys in enumerate([range(0, 30), range(10, 20)]):
        _write(spark, path, batch, keys)
    compaction.compact(spark, path, SCHEMA, KEY)
    _write(spark, path, 2, range(25, 40))
    want = _rows(read_batches(spark, path, SCHEMA, KEY))
    orphan = compaction.merge(spark, path, SCHEMA, KEY)  # the process dies before the switch
    assert compaction.current_manifest(spark, path).version == 1
    assert _rows(compaction.read_current(spark, path, SCHEMA, KEY)) == want
    second = compaction.compact(spark, path, SCHEMA, KEY)
    assert second.version == 2 and second.base != orphan.base
    assert compaction.vacuum(spark, path) == 5  # batches 0 to 2, the first base and the orphan
    assert compaction.batches(spark, path) == []
    assert _rows(compaction.read_current(spark, path, SCHEMA, KEY)) == want
