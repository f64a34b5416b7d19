"""Token ids of whole texts, and flat binary token files (dealt operator 4).

Files of a corpus, in a folder of their own:

* ``<part>.ids``: the ids of all documents of a part one after another, unsigned
  little-endian integers of 16 bits if the vocabulary allows it, else of 32;
* ``<part>.offsets``: n + 1 little-endian 64-bit numbers, where each document
  begins within the part and where the last one ends;
* ``<part>.docs``: n little-endian 64-bit document ids;
* ``manifest``: a Parquet table with a row for each part: its files, number of
  documents and ids, and its bases, which are prefix sums over the parts.

A part's files have names of their own for each attempt of a task, and only the
rows that Spark commits to the manifest say which files count. So a task that
runs twice, or is lost half way, leaves files that nobody reads.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import ship, worker_cache
from docflow.session import scratch_dir

END_ID = 2
MAX_CHUNKS = 300_000
MAX_WORDS = 200_000
NO_ID = -(1 << 63)
MANIFEST = "part long, name string, dtype string, n_docs long, n_ids long"
PLACED = f"{MANIFEST}, base_doc long, base_id long"

# Runs of letters that are words of the tokenizer by themselves, and the rest.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ"


class Known(dict):
    """What was encoded lately, two generations of bounded size; a miss costs time only."""

    def __init__(self, encode: Callable[[str], bytes], bound: int):
        self.encode, self.bound = encode, bound
        self.old: dict[str, bytes] = {}

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[text] = ids
        return ids


class Encoder:
    """Ids of texts by a tokenizer file of the tokenizers library.

    Its pre-tokenizer never joins what white space parts, so texts are cut into
    chunks there and the library encodes each distinct chunk once; known chunks
    are kept up to a bound, which changes the speed and not the ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain = re.compile(f"[!-&(-;=-~{LETTERS}]+").fullmatch
        self.pieces = re.compile(f"[{LETTERS}]+|[^{LETTERS}]+").findall
        self.odd_space = re.compile("[\x1c-\x1f]").search
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.usual = re.compile(f"([{LETTERS}]+)([,.;:!?]?)").fullmatch
        self.chunks = Known(self._chunk, MAX_CHUNKS)
        self.words = Known(self._piece, MAX_WORDS)

    @property
    def dtype(self) -> str:
        return "<u4" if self.wide else "<u2"

    def _pack(self, ids: list[int]) -> bytes:
        return array("I" if self.wide else "H", ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece[0].isalpha():
            mapped = piece if piece.isascii() else self.bytes.pre_tokenize_str(piece)[0][0]
            return self._pack([t.id for t in self.model.tokenize(mapped)])
        return self._pack(self.library.encode(piece, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> bytes:
        usual = self.usual(chunk)
        if usual:
            word, mark = usual.groups()
            ids = self.words[word.lower()]
            return ids + self.words[mark] if mark else ids
        if not self.plain(chunk):
            return self._pack(self.library.encode(chunk, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, self.pieces(chunk.lower())))

    def __call__(self, text: str | None) -> bytes:
        """Ids of a text as bytes of ``dtype``; a null text has none."""
        if not text:
            return b""
        parts = re.split("[ \t\n\r]+", text) if self.odd_space(text) else text.split()
        return b"".join(map(self.chunks.__getitem__, parts))


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    cache = worker_cache("encoders")
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def crc_u32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that pyarrow knows by its URI; a plain path is a shared folder."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _part_writer(folder: str, tokenizer: str, end_id: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        store, at = _store(folder)
        store.create_dir(at, recursive=True)
        end = np.array([end_id], encode.dtype).tobytes()
        width, n_ids, n_docs = len(end), 0, 0
        with (
            store.open_output_stream(f"{at}/{name}.ids") as ids,
            store.open_output_stream(f"{at}/{name}.offsets") as offsets,
            store.open_output_stream(f"{at}/{name}.docs") as docs,
        ):
            offsets.write(np.array([0], "<i8").tobytes())
            for batch in batches:
                starts = []
                for text in batch.column(1):
                    found = encode(text.as_py()) + end
                    ids.write(found)
                    n_ids += len(found) // width
                    starts.append(n_ids)
                offsets.write(np.array(starts, "<i8").tobytes())
                filled = batch.column(0).fill_null(NO_ID)
                docs.write(filled.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs += len(starts)
        if n_docs:
            row = [[part], [name], [encode.dtype], [n_docs], [n_ids]]
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(v, t) for v, t in zip(row, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "name", "dtype", "n_docs", "n_ids"])

    return write


def write_token_files(
    df: DataFrame,
    tokenizer: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Write the documents' ids in ascending ``id_col`` order; returns the manifest.

    Each document's ids are followed by ``end_id``. A null or empty text is the
    end id alone; rows with a null id come first and keep a null id; equal ids
    are ordered by text, and equal rows are all kept. Other columns are ignored.
    An empty table gives an empty manifest. The order is made by range
    partitioning, bounded parts of it are sorted, and only the number of ids of
    each part is gathered to place the parts.
    """
    spark = df.sparkSession
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = (
        slim.repartitionByRange(partitions, "doc_id") if partitions else slim.repartitionByRange("doc_id")
    )
    ranged = ranged.sortWithinPartitions("doc_id", "text")
    parts = ranged.mapInArrow(_part_writer(f"{folder}/parts", tokenizer, end_id), MANIFEST)
    parts.write.parquet(f"{folder}/counted")
    # One row for each part: bounded by the number of tasks.
    counted = spark.read.schema(MANIFEST).parquet(f"{folder}/counted")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    placed = counted.select(
        *counted.columns,
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("base_doc"),
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base_id"),
    )
    placed.write.parquet(f"{folder}/manifest")
    return spark.read.schema(PLACED).parquet(f"{folder}/manifest")


def open_part(folder: str, name: str, dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, offsets and document ids of a part, memory-mapped where the store is a folder."""
    store, at = _store(folder)

    def load(kind: str, of: str) -> np.ndarray:
        path = f"{at}/parts/{name}.{kind}"
        if isinstance(store, pafs.LocalFileSystem):
            return np.memmap(path, of, "r") if os.path.getsize(path) else np.zeros(0, of)
        with store.open_input_file(path) as file:
            return np.frombuffer(file.readall(), of)

    return load("ids", dtype), load("offsets", "<i8"), load("docs", "<i8")


READ = "doc_id long, position long, start long, n_tokens long, ids_crc32 long"


def _part_reader(folder: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, docs = open_part(folder, row["name"], row["dtype"])
                for at in range(0, len(docs), 10_000):
                    some = docs[at : at + 10_000]
                    ends = offsets[at : at + len(some) + 1]
                    crc = [crc_u32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    place = np.arange(at, at + len(some)) + row["base_doc"]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some, pa.int64(), mask=some == NO_ID),
                            pa.array(place, pa.int64()),
                            pa.array(ends[:-1] + row["base_id"], pa.int64()),
                            pa.array(np.diff(ends), pa.int64()),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "position", "start", "n_tokens", "ids_crc32"],
                    )

    return read


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document in the files, one task for each part."""
    manifest = spark.read.schema(PLACED).parquet(f"{folder}/manifest")
    spread = manifest.repartition(max(1, manifest.count()), "part")
    return spread.mapInArrow(_part_reader(folder), READ)


def token_file_digest(df: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the files of ``df`` to a scratch folder and read them back."""
    spark = df.sparkSession
    folder = scratch_dir(spark, "tokens")
    write_token_files(df, tokenizer, folder, **options)
    return read_token_files(spark, folder)


ship(__name__)
