"""Sum-of-squares online packing of tokenised documents (dealt operator 1).

Each task packs the documents of its partition one by one into windows of
``window`` ids. What fills whole windows is cut off first; the rest of a
document goes to the open window whose new fill makes the sum of squared
counts of partially filled levels least, by an array with the number of open
windows at each level. Open windows are bounded in number: beyond the bound,
and at the end, the emptiest ones are cut into the holes of the fullest, so no
window but the last stays partial. The last one is cut at powers of two, which
need no padding.

Sequence numbers run through all tasks by prefix sums of their counts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import ship, written
from docflow.llm.tokens import END_ID, crc_u32, encoder

WINDOW = 4096
MAX_OPEN = 1024
BATCH = 4096

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "part long, in_part long, offset long, sequence_tokens long"
)
NAMES = [field.split()[0] for field in PIECES.split(", ")]

# A piece is (doc_id, start, ids, doc_tokens).


def best_level(counts: np.ndarray, size: int) -> int:
    """The fill to put ``size`` ids on, 0 for a new window; ties go to the fullest."""
    window = len(counts) - 1
    below = counts[1 : window - size + 1]
    change = 2 * (counts[1 + size :] - below) + 2
    change[-1:] = 1 - 2 * below[-1:]
    change[below == 0] = np.iinfo(np.int64).max
    if len(change):
        level = len(change) - int(np.argmin(change[::-1]))
        if change[level - 1] <= 2 * counts[size] + 1:
            return level
    return 0


class Packer:
    """Packs pieces online; finished windows are taken from ``done``."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = defaultdict(list)
        self.n_open = 0
        self.done: list[list] = []

    def _put(self, pieces: list, fill: int) -> None:
        if fill == self.window:
            self.done.append(pieces)
            return
        self.open[fill].append(pieces)
        self.counts[fill] += 1
        self.n_open += 1

    def _take(self, fill: int) -> list:
        self.counts[fill] -= 1
        self.n_open -= 1
        return self.open[fill].pop()

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        size, total = len(ids) % self.window, len(ids)
        for start in range(0, total - size, self.window):
            self.done.append([(doc_id, start, ids[start : start + self.window], total)])
        if size:
            level = best_level(self.counts, size)
            pieces = self._take(level) if level else []
            pieces.append((doc_id, total - size, ids[total - size :], total))
            self._put(pieces, level + size)
            if self.n_open > self.max_open:
                self.fill_holes()

    def fill_holes(self) -> None:
        """Cut the emptiest windows into the holes of the fullest, one partial window stays."""
        ranked = [w for fill in sorted(self.open) for w in self.open[fill]]
        self.open.clear()
        self.counts[:] = 0
        self.n_open = 0
        spare: list = []  # pieces of the emptiest windows
        low, high = 0, len(ranked)
        while low < high:
            high -= 1
            pieces = ranked[high]
            hole = self.window - sum(len(p[2]) for p in pieces)
            while hole and (spare or low < high):
                if not spare:
                    spare = ranked[low][::-1]
                    low += 1
                doc_id, start, ids, total = spare.pop()
                pieces.append((doc_id, start, ids[:hole], total))
                if len(ids) > hole:
                    spare.append((doc_id, start + hole, ids[hole:], total))
                hole -= min(hole, len(ids))
            self._put(pieces, self.window - hole)
        if spare:
            self._put(spare[::-1], sum(len(p[2]) for p in spare))

    def finish(self) -> None:
        """Close all windows; the last partial one is cut at powers of two."""
        self.fill_holes()
        while self.n_open > 1:
            self.fill_holes()
        rest = [p for windows in self.open.values() for w in windows for p in w][::-1]
        left = sum(len(p[2]) for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            pieces = []
            while size:
                doc_id, start, ids, total = rest.pop()
                pieces.append((doc_id, start, ids[:size], total))
                if len(ids) > size:
                    rest.append((doc_id, start + size, ids[size:], total))
                size -= min(size, len(ids))
            self.done.append(pieces)
        self.open.clear()
        self.counts[:] = 0
        self.n_open = 0


def _pack_part(tokenizer: str, end_id: int, window: int) -> Callable:
    def rows_of(packer: Packer, part: int, first: int) -> Iterator[tuple]:
        for at, pieces in enumerate(packer.done):
            offset, total = 0, sum(len(p[2]) for p in pieces)
            for doc_id, start, ids, doc_tokens in pieces:
                crc = crc_u32(ids)
                yield doc_id, start, len(ids), crc, doc_tokens, part, first + at, offset, total
                offset += len(ids)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, packer = encoder(tokenizer), TaskContext.get().partitionId(), Packer(window)
        end = np.array([end_id], encode.dtype).tobytes()
        rows: list[tuple] = []
        sequences = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, NAMES)

        def drain() -> None:
            nonlocal sequences
            rows.extend(rows_of(packer, part, sequences))
            sequences += len(packer.done)
            packer.done.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, np.frombuffer(encode(text.as_py()) + end, encode.dtype))
                drain()
                if len(rows) >= BATCH:
                    yield flush()
        packer.finish()
        drain()
        if rows:
            yield flush()

    return pack


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    window: int = WINDOW,
) -> DataFrame:
    """A row for each piece of a document: where it is in the document and in which sequence.

    Texts are tokenised and ``end_id`` is appended; a null or empty text is that
    id alone. Every id is in exactly one piece. A row with a null id is packed
    like any other; equal rows are packed as often as they occur. An empty
    table gives no rows. Other columns are ignored. Sequences are numbered
    without gaps; each has ``window`` ids or a power of two. No document leaves
    its task: only piece rows are written, and only one count for each task is
    gathered.
    """
    slim = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(slim.mapInArrow(_pack_part(tokenizer, end_id, window), PIECES), "pieces")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        pieces.groupBy("part")
        .agg((F.max("in_part") + 1).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    return pieces.join(bases, "part").select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("base") + F.col("in_part")).alias("sequence_id"),
        "offset",
        "sequence_tokens",
    )


ship(__name__)
