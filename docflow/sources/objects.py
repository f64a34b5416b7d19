"""Stored documents: a folder of files, a table, or single objects by key."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.operators.lookup import OBJECT_KEY, OBJECT_PART, Fetcher
from docflow.session import stored_once
from docflow.sources.packs import PACKS_DIR, pack_entries, put_time, unpack
from docflow.sources.sinks import latest

# A batch is held about three times over, by each task of an executor.
BYTES_PER_BATCH = 8 * 1024 * 1024
READERS = 8


def _folder_store(path: str):
    """Whether pyarrow opens ``path`` as a folder; workers then list and read it."""
    from pyarrow import ArrowException
    from pyarrow import fs as arrow_fs

    try:
        store, root = arrow_fs.FileSystem.from_uri(path.rstrip("/") or "/")
        return store.get_file_info(root).type == arrow_fs.FileType.Directory
    except (ArrowException, OSError, ValueError):
        return False


def read_objects(spark: SparkSession, path: str, bucket: str, glob: str = "*") -> DataFrame:
    """All files below a folder; the key is the path relative to that folder.

    Tasks list the folders, one level of them after the other, and read the files, so
    the driver holds none of their names. What only Spark's own reader opens (a
    pattern, a single file, another scheme) is listed by the driver. Of a bucket that
    holds packs these are all objects in them, with the time of their put.
    """
    if _folder_store(f"{path.rstrip('/')}/{PACKS_DIR}"):
        found = _packed(spark, path, glob).withColumn("modificationTime", put_time())
        return unpack(found, path.rstrip("/")).select(
            F.lit(bucket).alias("Bucket"),
            "Key",
            "content",
            F.octet_length("content").cast("long").alias("length"),
            "modificationTime",
        )
    if _folder_store(path):
        return _read_files(_list_files(spark, path, glob), path, bucket)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )
    # Paths come back with a scheme; what follows the folder's own path is the key.
    folder = unquote(path.split("://", 1)[-1]).removeprefix("file:").rstrip("/") + "/"
    key = F.substr("path", F.instr("path", folder) + F.lit(len(folder)))
    return files.select(
        F.lit(bucket).alias("Bucket"), key.alias("Key"), "content", "length", "modificationTime"
    )


LISTED = T.StructType([T.StructField("Key", T.StringType()), T.StructField("folder", T.BooleanType())])


def _list_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(Key) of all files below a folder that Spark would read, from one job for each level."""
    entries_per_batch = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        from fnmatch import fnmatchcase

        from pyarrow import fs as arrow_fs

        store, root = arrow_fs.FileSystem.from_uri(path.rstrip("/") or "/")

        def entries(folder):
            where = f"{root}/{folder}" if folder else root
            if isinstance(store, arrow_fs.LocalFileSystem):
                # Streamed: a folder may hold more names than fit one list.
                with os.scandir(where) as found:
                    yield from ((entry.name, entry.is_dir()) for entry in found)
            else:
                for info in store.get_file_info(arrow_fs.FileSelector(where)):
                    yield info.base_name, info.type == arrow_fs.FileType.Directory

        def hidden(name):
            return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")

        def batch_of(rows):
            keys, folders = zip(*rows)
            columns = [pa.array(keys, pa.string()), pa.array(folders, pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=["Key", "folder"])

        rows = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for name, is_folder in entries(folder):
                    if hidden(name) or not (is_folder or fnmatchcase(name, glob)):
                        continue
                    rows.append((f"{folder}/{name}" if folder else name, is_folder))
                    if len(rows) >= entries_per_batch:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    level, files = spark.createDataFrame([("",)], "Key string"), []
    while True:
        found = stored_once(level.mapInArrow(run, LISTED), "listing")
        files.append(found.where("NOT folder").select("Key"))
        folders = found.where("folder").select("Key")
        if folders.isEmpty():
            return reduce(DataFrame.unionAll, files)
        level = folders.repartition(4 * spark.sparkContext.defaultParallelism, "Key")


def _packed(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(Key, pack, at) of the objects in a bucket's packs; of one put several times, the last.

    Entries of a pack follow each other. Only the keys put again leave the tasks that
    read the packs, as far as they fit a broadcast.
    """
    folder = path.rstrip("/")
    files = _list_files(spark, f"{folder}/{PACKS_DIR}", "*.zip")
    width = 4 * spark.sparkContext.defaultParallelism
    packs = files.select(F.concat(F.lit(f"{PACKS_DIR}/"), "Key").alias("pack")).repartition(width, "pack")
    entries = pack_entries(packs, folder, glob).withColumn("batch_id", F.struct("pack", "at"))
    found = latest(entries, ["Key"])
    if found is not entries:
        found = found.repartition(width, "pack").sortWithinPartitions("pack", "at")
    return found.drop("batch_id")


def _read_files(files: DataFrame, path: str, bucket: str) -> DataFrame:
    """Files by their keys with content, length and time, some read at once by each task."""
    schema = T.StructType(
        [
            T.StructField("Key", T.StringType()),
            T.StructField("content", T.BinaryType()),
            T.StructField("modified_ms", T.LongType()),
        ]
    )
    readers, bytes_per_batch = READERS, BYTES_PER_BATCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        from pyarrow import fs as arrow_fs

        store, root = arrow_fs.FileSystem.from_uri(path.rstrip("/") or "/")

        def read(key):
            file = f"{root}/{key}"
            modified = store.get_file_info(file).mtime_ns
            with store.open_input_stream(file) as stream:
                return key, stream.read(), modified // 1_000_000 if modified is not None else None

        def batch_of(rows):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

        with ThreadPoolExecutor(readers) as pool:
            for batch in batches:
                keys, rows, size = batch.column(0).to_pylist(), [], 0
                for at in range(0, len(keys), readers):
                    some = list(pool.map(read, keys[at : at + readers]))
                    rows += some
                    size += sum(len(content) for _, content, _ in some)
                    if size >= bytes_per_batch:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    spread = files.repartition(4 * files.sparkSession.sparkContext.defaultParallelism, "Key")
    return spread.mapInArrow(run, schema).select(
        F.lit(bucket).alias("Bucket"),
        "Key",
        "content",
        F.octet_length("content").cast("long").alias("length"),
        F.timestamp_millis("modified_ms").alias("modificationTime"),
    )


def object_part(parts: int) -> Column:
    """Part of a partitioned object table that an object belongs to."""
    return F.pmod(F.xxhash64(*OBJECT_KEY), F.lit(parts)).cast("int")


def save_partitioned(objects: DataFrame, path: str, parts: int) -> None:
    """Store objects in ``parts`` folders by a hash of their key.

    ``table_fetcher(..., parts=parts)`` then reads only those that a batch names.
    """
    rows = objects.withColumn(OBJECT_PART, object_part(parts))
    rows.repartition(parts, OBJECT_PART).write.mode("overwrite").partitionBy(OBJECT_PART).parquet(path)


def save_objects_table(objects: DataFrame, table: str, buckets: int) -> None:
    """Store objects bucketed by (Bucket, Key), so that lookups of notifications
    bucketed or shuffled alike never move the contents again."""
    (
        objects.write.mode("overwrite")
        .bucketBy(buckets, *OBJECT_KEY)
        .sortBy(*OBJECT_KEY)
        .saveAsTable(table)
    )


OUTSIDE = "key is empty or leaves the store"


def _packed_fetcher(base_uri: str) -> Fetcher:
    """``store_fetcher`` over buckets of packs."""
    base = base_uri.rstrip("/")

    def fetch(notifications: DataFrame) -> DataFrame:
        from pyarrow import fs as arrow_fs

        spark = notifications.sparkSession
        columns = [*notifications.columns, "content", "error"]
        bucket, key = F.coalesce("Bucket", F.lit("")), F.coalesce("Key", F.lit(""))
        outside = (
            bucket.isin("", ".", "..")
            | bucket.contains("/")
            | (key == "")
            | key.startswith("/")
            | F.array_contains(F.split(key, "/"), "..")
        )
        store, root = arrow_fs.FileSystem.from_uri(base_uri)
        stored = spark.createDataFrame([], "Bucket string, Key string, pack string, at bigint")
        for info in store.get_file_info(arrow_fs.FileSelector(root, allow_not_found=True)):
            name = info.base_name
            folder = f"{base}/{quote(name) if '://' in base else name}"
            if _folder_store(f"{folder}/{PACKS_DIR}"):
                pack = F.concat(F.lit(f"{name}/"), "pack").alias("pack")
                stored = stored.unionAll(_packed(spark, folder).select(F.lit(name), "Key", pack, "at"))
        located = notifications.where(~outside).join(stored, OBJECT_KEY)
        width = 4 * spark.sparkContext.defaultParallelism
        located = located.repartition(width, "pack").sortWithinPartitions("pack", "at")
        found = unpack(located, base_uri).withColumn("error", F.lit(None).cast("string"))
        wrong = notifications.where(outside).withColumns(
            {"content": F.lit(None).cast("binary"), "error": F.lit(OUTSIDE)}
        )
        return found.select(*columns).unionAll(wrong.select(*columns))

    return fetch


def store_fetcher(base_uri: str, tasks: int | None = None, packed: bool = False) -> Fetcher:
    """Lookup of single objects at ``base_uri/Bucket/Key``, one read per row.

    For small batches against a large store: the work grows with the notifications
    and not with what is stored. A missing object gives no row. One that cannot be
    read, or whose key is empty or leaves its bucket, gives a row without content and
    with an ``error``; only a failing connection fails the task, which Spark retries.
    The few bytes of the keys would be put into one partition, so they are spread
    over ``tasks`` (four per core) instead, and each task reads ``READERS`` at once.
    With ``packed`` the objects are looked up in packs, whose directories are all read for
    each call; without it a bucket of packs fails the task.
    """
    if packed:
        return _packed_fetcher(base_uri)
    packs_dir, told_outside = PACKS_DIR, OUTSIDE

    def fetch(notifications: DataFrame) -> DataFrame:
        cores = notifications.sparkSession.sparkContext.defaultParallelism
        notifications = notifications.repartition(tasks or 4 * cores, *OBJECT_KEY)
        schema = T.StructType(
            [
                *notifications.schema.fields,
                T.StructField("content", T.BinaryType()),
                T.StructField("error", T.StringType()),
            ]
        )
        readers = READERS
        bytes_per_batch = BYTES_PER_BATCH

        def with_contents(batch, rows, found):
            contents = pa.array([c for c, _ in found], pa.binary())
            errors = pa.array([e for _, e in found], pa.string())
            columns = batch.take(pa.array(rows, pa.int64())).columns
            return pa.RecordBatch.from_arrays([*columns, contents, errors], names=schema.fieldNames())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from concurrent.futures import ThreadPoolExecutor

            from pyarrow import fs as arrow_fs

            store, root = arrow_fs.FileSystem.from_uri(base_uri)

            def read(bucket, key):
                """Content and error of an object, None if there is none."""
                if not bucket or not key or "/" in bucket or key.startswith("/"):
                    return None, told_outside
                if {".", ".."} & {bucket} or ".." in key.split("/"):
                    return None, told_outside
                try:
                    with store.open_input_stream(f"{root}/{bucket}/{key}") as stream:
                        return stream.read(), None
                except FileNotFoundError:
                    if store.get_file_info(f"{root}/{bucket}/{packs_dir}").type != arrow_fs.FileType.NotFound:
                        raise ValueError(f"bucket holds packed objects: {bucket}") from None
                    return None
                except (ConnectionError, TimeoutError):
                    raise
                except OSError as error:
                    return None, f"{type(error).__name__}: {error}"[:500]

            with ThreadPoolExecutor(readers) as pool:
                for batch in batches:
                    buckets, keys = (
                        batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("Bucket", "Key")
                    )
                    rows, found, size = [], [], 0
                    for at in range(0, len(keys), readers):
                        some = slice(at, at + readers)
                        for row, got in enumerate(pool.map(read, buckets[some], keys[some]), at):
                            if got is None:
                                continue
                            rows.append(row)
                            found.append(got)
                            size += len(got[0] or b"")
                        if size >= bytes_per_batch:
                            yield with_contents(batch, rows, found)
                            rows, found, size = [], [], 0
                    if rows:
                        yield with_contents(batch, rows, found)

        return notifications.mapInArrow(run, schema)

    return fetch
