"""Packs: many small objects of a bucket in few files.

A disk gives each file whole blocks, and each folder of a nested key one more, so an object
of a kilobyte takes several times its size. A pack is a zip archive of the objects that one
task put, each an entry of its own under its whole key, compressed and with a checksum; any
reader of zip archives gives them out. Packs lie in ``Bucket/_packs`` and are never changed:
their name begins with the time of the put by the driver's clock, and of an object in several
packs that of the last put counts. What was replaced keeps its room.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKS_DIR = "_packs"

# A task holds one pack as it grows, and the directory of its entries.
PACK_BYTES = 16 * 1024 * 1024
PACK_OBJECTS = 16_384
# A batch is held about three times over, by each task of an executor.
BYTES_PER_BATCH = 8 * 1024 * 1024

ENTRY = T.StructType(
    [
        T.StructField("Key", T.StringType()),
        T.StructField("pack", T.StringType()),
        T.StructField("at", T.LongType()),
    ]
)


def pack_objects(bodies: DataFrame, base_uri: str, receipt: T.StructType) -> DataFrame:
    """Store rows of bucket, key and body in packs; a receipt comes when its pack is complete.

    A task that is run again leaves a second pack with equal objects, which does no harm.
    """
    put_at = time.time_ns()
    packs_dir, pack_bytes, pack_objects = PACKS_DIR, PACK_BYTES, PACK_OBJECTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import warnings
        import zipfile

        from pyarrow import fs as arrow_fs

        store, root = arrow_fs.FileSystem.from_uri(base_uri)
        on_disk = isinstance(store, arrow_fs.LocalFileSystem)
        stamp = time.gmtime(put_at // 1_000_000_000)[:6]
        # An object that comes twice is two entries, of which the last counts.
        warnings.filterwarnings("ignore", "Duplicate name")
        checked: set[str] = set()
        growing: dict[str, tuple] = {}

        def check(bucket):
            found = store.get_file_info(arrow_fs.FileSelector(f"{root}/{bucket}", allow_not_found=True))
            if any(not info.base_name.startswith(("_", ".")) for info in found):
                raise ValueError(f"bucket holds objects that are files: {bucket}")
            checked.add(bucket)

        def complete():
            """Receipts of the packs that grew, each put in place first."""
            for bucket, (buffer, pack, keys, sizes) in growing.items():
                pack.close()
                folder = f"{root}/{bucket}/{packs_dir}"
                path = f"{folder}/{put_at:020d}-{uuid.uuid4().hex}.zip"
                target = f"{path}.part" if on_disk else path
                if on_disk:
                    store.create_dir(folder, recursive=True)
                with store.open_output_stream(target) as stream:
                    stream.write(buffer.getvalue())
                if on_disk:
                    store.move(target, path)
                columns = [pa.array([bucket] * len(keys), pa.string()), pa.array(keys, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], names=receipt.fieldNames())
            growing.clear()

        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            for bucket, key, body in zip(*(column.to_pylist() for column in batch.columns)):
                if ".." in f"{bucket}/{key}".split("/") or "\0" in f"{bucket}/{key}":
                    raise ValueError(f"key leaves the store: {bucket}/{key}")
                if bucket not in growing:
                    if bucket not in checked:
                        check(bucket)
                    buffer = io.BytesIO()
                    growing[bucket] = (buffer, zipfile.ZipFile(buffer, "w"), [], [])
                _, pack, keys, sizes = growing[bucket]
                pack.writestr(zipfile.ZipInfo(f"{key}", stamp), body, zipfile.ZIP_DEFLATED, 1)
                keys.append(key)
                sizes.append(len(body))
            full = sum(buffer.tell() for buffer, *_ in growing.values()) >= pack_bytes
            if full or sum(len(keys) for _, _, keys, _ in growing.values()) >= pack_objects:
                yield from complete()
        yield from complete()

    return bodies.mapInArrow(run, receipt)


def pack_entries(packs: DataFrame, path: str, glob: str = "*") -> DataFrame:
    """(Key, pack, at) of the objects in packs, whose paths below ``path`` are ``pack``;
    ``at`` is an entry's place in its pack. Reads only the directories of the packs."""
    entries_per_batch = 4096
    names = ENTRY.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile
        from fnmatch import fnmatchcase

        from pyarrow import fs as arrow_fs

        store, root = arrow_fs.FileSystem.from_uri(path)
        for batch in batches:
            for pack in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/{pack}") as file, zipfile.ZipFile(file) as opened:
                    infos = [i for i in opened.infolist() if fnmatchcase(i.filename.rsplit("/", 1)[-1], glob)]
                for first in range(0, len(infos), entries_per_batch):
                    some = infos[first : first + entries_per_batch]
                    columns = [
                        pa.array([i.filename for i in some], pa.string()),
                        pa.array([pack] * len(some), pa.string()),
                        pa.array([i.header_offset for i in some], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return packs.select("pack").mapInArrow(run, ENTRY)


def unpack(rows: DataFrame, path: str) -> DataFrame:
    """Rows with the ``content`` their ``pack`` and ``at`` name, in place of these two.

    Rows of one pack should follow each other: a task keeps one pack open.
    """
    fields = [field for field in rows.schema.fields if field.name not in ("pack", "at")]
    schema = T.StructType([*fields, T.StructField("content", T.BinaryType())])
    names = [field.name for field in fields]
    bytes_per_batch = BYTES_PER_BATCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        from pyarrow import fs as arrow_fs

        store, root = arrow_fs.FileSystem.from_uri(path)
        pack = file = opened = None
        infos: dict = {}

        def batch_of(kept, contents):
            return pa.RecordBatch.from_arrays([*kept.columns, pa.array(contents, pa.binary())], names=[*names, "content"])

        for batch in batches:
            packs, places = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("pack", "at"))
            kept = batch.select(names)
            first, contents, size = 0, [], 0
            for row, (name, at) in enumerate(zip(packs, places)):
                if name != pack:
                    if file is not None:
                        opened.close()
                        file.close()
                    file = store.open_input_file(f"{root}/{name}")
                    opened, pack = zipfile.ZipFile(file), name
                    infos = {info.header_offset: info for info in opened.infolist()}
                contents.append(opened.read(infos[at]))
                size += len(contents[-1])
                if size >= bytes_per_batch:
                    yield batch_of(kept.slice(first, len(contents)), contents)
                    first, contents, size = row + 1, [], 0
            if contents:
                yield batch_of(kept.slice(first, len(contents)), contents)
        if file is not None:
            opened.close()
            file.close()

    return rows.mapInArrow(run, schema)


def put_time(pack: str = "pack") -> Column:
    """Time of the put that made a pack, from its name."""
    # The name has nanoseconds; its digits but the last six are milliseconds.
    return F.timestamp_millis(F.regexp_extract(pack, r"(\d+)\d{6}-[^/]*$", 1).cast("bigint"))
