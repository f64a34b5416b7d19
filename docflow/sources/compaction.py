"""Base and delta tables of outputs written by ``write_batch``, merged by key.

A table written batch by batch (``path/batch_id=N``) grows with every rewrite,
and finding the current row of each key reads the keys of all batches. Here a
merge writes the current rows up to some batch into a base folder of its own
(``path/_compacted/<id>``) and then switches a manifest to it. Readers take the
newest manifest, read its base and only the batches after it, and find the
keys rewritten since among those deltas alone: their work follows the deltas
since the last merge, not the table's history.

A manifest is an empty file whose name holds its version, the last batch its
base covers and the base's folder (``_manifest/v<version>-<through>-<id>``);
creating a file is atomic on every file system Spark writes to, so a reader
sees the old manifest or the new one. A crash after a base is written and
before its manifest leaves a folder that no manifest names: readers never see
it, and ``vacuum`` removes it with the batches a manifest covers. Folders whose
names start with ``_`` are hidden from Spark's readers of ``path``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.operators.lookup import broadcast_if_small, row_bytes
from docflow.sources.sinks import latest, read_or_empty

MANIFESTS = "_manifest"
BASES = "_compacted"


@dataclass(frozen=True)
class Manifest:
    version: int
    through: int
    base: str


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def current_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest of highest version, or None before the first merge."""
    fs, folder = _fs(spark, f"{path}/{MANIFESTS}")
    if not fs.exists(folder):
        return None
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v") and name.count("-") >= 2:
            version, through, base = name[1:].split("-", 2)
            found.append(Manifest(int(version), int(through), base))
    return max(found, key=lambda m: m.version, default=None)


def _with_batch(schema: T.StructType) -> T.StructType:
    if "batch_id" in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def batches(spark: SparkSession, path: str) -> list[int]:
    """Batch ids written below ``path``, from the folder names alone."""
    fs, folder = _fs(spark, path)
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id="))


def _switch(spark: SparkSession, path: str, manifest: Manifest) -> None:
    fs, file = _fs(spark, f"{path}/{MANIFESTS}/v{manifest.version:012d}-{manifest.through}-{manifest.base}")
    if not fs.createNewFile(file):
        raise RuntimeError(f"manifest {manifest.version} of {path} exists: another merge ran at the same time")


def read_current(spark: SparkSession, path: str, schema: T.StructType, key_cols: Sequence[str]) -> DataFrame:
    """The newest row of every key, with its ``batch_id``: the base and the batches after it."""
    full = _with_batch(schema)
    manifest = current_manifest(spark, path)
    rows = read_or_empty(spark, path, full)
    if manifest is None:
        return latest(rows, key_cols)
    base = spark.read.schema(full).parquet(f"{path}/{BASES}/{manifest.base}")
    deltas = latest(rows.where(F.col("batch_id") > manifest.through), key_cols)
    keys = deltas.select(*key_cols).distinct()
    size = keys.agg(row_bytes(keys)).first()[0]
    if not size:
        return base
    # Keys written since the merge replace theirs in the base; only the deltas are grouped.
    kept = base.join(broadcast_if_small(keys, size), list(key_cols), "left_anti")
    return kept.unionByName(deltas)


def merge(spark: SparkSession, path: str, schema: T.StructType, key_cols: Sequence[str]) -> Manifest | None:
    """Write the current rows into a new base; returns the manifest to switch to (None: nothing new)."""
    before = current_manifest(spark, path)
    written = batches(spark, path)
    newest = written[-1] if written else None
    if newest is None or (before is not None and newest <= before.through):
        return None
    base = uuid.uuid4().hex
    read_current(spark, path, schema, key_cols).where(F.col("batch_id") <= newest).write.parquet(
        f"{path}/{BASES}/{base}"
    )
    return Manifest((before.version if before else 0) + 1, int(newest), base)


def compact(spark: SparkSession, path: str, schema: T.StructType, key_cols: Sequence[str]) -> Manifest | None:
    """Merge, then switch the manifest to the new base."""
    manifest = merge(spark, path, schema, key_cols)
    if manifest is not None:
        _switch(spark, path, manifest)
    return manifest


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove the batches the current base covers and every other base; returns how many.

    A reader that took an older manifest before may lose its files: vacuum when
    no such reader runs.
    """
    manifest = current_manifest(spark, path)
    if manifest is None:
        return 0
    fs, folder = _fs(spark, path)
    gone = 0
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=", 1)[1]) <= manifest.through:
            gone += bool(fs.delete(status.getPath(), True))
    _, bases = _fs(spark, f"{path}/{BASES}")
    for status in fs.listStatus(bases):
        if status.getPath().getName() != manifest.base:
            gone += bool(fs.delete(status.getPath(), True))
    return gone
