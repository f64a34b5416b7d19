"""Alignment of two tokenizers' tokens by interval coalescing (dealt operator 12).

Tokenizer A is byte-level BPE over ``" " + text``; tokenizer B is a
sentencepiece model over ``text`` (it adds the space itself). Each token
covers a byte range of that same byte string. All A and B tokens of a
document are sorted by start (``lexsort``), the running maximum of their ends
is taken (``maximum.accumulate``), and a group ends where a start reaches that
maximum: exactly at the offsets where tokens of both sides end. Within a group
the A tokens and the B tokens cover the same bytes.

A link is a pair of an A token and a B token that end at the same offset. The
corpus-wide count of an (A id, B id) pair is the number of links that hold
it; counts are summed over all documents by Spark, pre-aggregated within each
document, and the best pair of each B id is its highest count.

Neither tokenizer joins what a space between two other characters parts, so
both sides have a cut there: texts are cut into chunks at those spaces, each
distinct chunk is encoded and coalesced once, and what was worked out is kept up
to a bound. A text with a chunk whose bytes a side does not give back is encoded
whole.

Tokenising happens in tasks, a batch of documents at a time; links go out as
distinct pairs of a document with their multiplicity, so a document sends at
most one row for each pair it has.

Defined results for odd input:

* a null, empty, or otherwise unencodable text (A's or B's joined token bytes
  differ from ``" " + text``, e.g. where B normalises characters) has no
  tokens: every count 0 and ``groups_sha256`` the empty string;
* strings of special tokens inside texts are plain text for both sides;
* very long texts are encoded whole;
* repeated rows are documents of their own, each adding its links to the counts;
* a null ``doc_id`` stays null; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import broadcast_if_small, ship, worker_cache, written

A_TOKENIZER = "byte_bpe_50k.json"
B_TOKENIZER = "piece_bpe_32k.model"
SALTS = 32
PAIR_ROW_BYTES = 40
BATCH = 256
# Chunks and their characters known at once, but for those of one batch.
MAX_CHUNKS, MAX_CHARS = 1 << 18, 1 << 22
CUT = re.compile(r" (?=\S)(?<=\S )")

OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<struct<a:int,b:int,n:long>>"
)


def byte_level_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in byte-level BPE vocabularies.

    Bytes that print as themselves keep their code point; the others, in order,
    take the code points from 256 on.
    """
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars = {b: chr(b) for b in own}
    extra = 0
    for b in range(256):
        if b not in chars:
            chars[b] = chr(256 + extra)
            extra += 1
    return {c: b for b, c in chars.items()}


class Sides:
    """Both tokenizers of a worker, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = []
        for i in range(self.a.get_vocab_size(with_added_tokens=True)):
            token = self.a.id_to_token(i) or ""
            if token in special:
                self.a_bytes.append(token.encode())
            else:
                self.a_bytes.append(bytes(alphabet.get(c, 0) for c in token))
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = re.compile(r"<0x([0-9A-Fa-f]{2})>")
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i) and byte.fullmatch(piece):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.b_bytes.append(b"")
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_flat = np.frombuffer(b"".join(self.a_bytes), np.uint8)
        self.b_flat = np.frombuffer(b"".join(self.b_bytes), np.uint8)
        self.a_start = np.cumsum(self.a_len) - self.a_len
        self.b_start = np.cumsum(self.b_len) - self.b_len
        made = json.loads(self.a.to_str())
        cut_by = made["pre_tokenizer"] or {}
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        self.parted = (
            made["normalizer"] is None
            and (cut_by.get("type"), cut_by.get("use_regex")) == ("ByteLevel", True)
            and not any("▁" in piece.lstrip("▁") for piece in pieces)
        )
        self.chunks = Chunks(self)


def sides(a_path: str, b_path: str) -> Sides:
    cache = worker_cache("align")
    if (a_path, b_path) not in cache:
        cache[(a_path, b_path)] = Sides(a_path, b_path)
    return cache[(a_path, b_path)]


def coalesce(a_ids: np.ndarray, a_len: np.ndarray, b_ids: np.ndarray, b_len: np.ndarray):
    """Groups and links of one document's tokens.

    Returns the group of each A and each B token, and the (A position, B
    position) of each link.
    """
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    starts = np.concatenate([a_end - a_len, b_end - b_len])
    ends = np.concatenate([a_end, b_end])
    side = np.concatenate([np.zeros(len(a_ids), np.int8), np.ones(len(b_ids), np.int8)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens) - 1
    _, at_a, at_b = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
    return group[: len(a_ids)], group[len(a_ids) :], at_a, at_b


POWERS = 10 ** np.arange(19, dtype=np.int64)


def decimal_bytes(ids: np.ndarray, seps: np.ndarray) -> np.ndarray:
    """Bytes of each non-negative id in decimal followed by its separator byte (0: none)."""
    digits = np.searchsorted(POWERS[1:], ids, side="right") + 1
    widths = digits + (seps != 0)
    starts = np.cumsum(widths) - widths
    out = np.empty(int(widths.sum()), np.uint8)
    for j in range(int(digits.max(initial=0))):
        has = digits > j
        place = POWERS[digits[has] - 1 - j]
        out[starts[has] + j] = 48 + (ids[has] // place) % 10
    cut = seps != 0
    out[(starts + digits)[cut]] = seps[cut]
    return out


def groups_text(a_ids, a_group, b_ids, b_group, last=None) -> bytes:
    """``a1,a2|b1;a3|b2,b3`` in UTF-8: each group's A ids, then its B ids, groups in order.

    A line ends after each group that ``last`` marks.
    """
    ids = np.concatenate([a_ids, b_ids])
    group = np.concatenate([a_group, b_group])
    side = np.concatenate([np.zeros(len(a_ids), np.int8), np.ones(len(b_ids), np.int8)])
    order = np.lexsort((np.arange(len(ids)), side, group))
    ids, group, side = ids[order], group[order], side[order]
    # Within a group A ids come first, then B ids; each group has both.
    seps = np.full(len(ids), ord(","), dtype=np.uint8)
    seps[:-1][side[:-1] != side[1:]] = ord("|")
    seps[:-1][group[:-1] != group[1:]] = ord(";")
    if last is not None:
        seps[:-1][(group[:-1] != group[1:]) & last[group[:-1]]] = ord("\n")
    seps[-1:] = 0
    return decimal_bytes(ids, seps).tobytes()


def spelled(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The bytes of a sequence of ids, from all ids' bytes one after another."""
    size = lengths[ids]
    total = int(size.sum())
    first = np.cumsum(size) - size
    return flat[np.repeat(starts[ids] - first, size) + np.arange(total)]


def _owners(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def _encoded(s: Sides, texts: list[str]) -> list[list]:
    """Ids of both sides for each text."""
    a = s.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
    return [[e.ids for e in a], s.b.encode(texts, num_threads=1)]


class Chunks:
    """Counts, groups and links of chunks of texts, worked out once for each distinct one."""

    def __init__(self, s: Sides):
        self.s = s
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.chars = 0
        self.texts: list[bytes] = []
        # n_a, n_b, n_groups, n_links, and whether a side does not give the bytes back.
        self.counts = np.zeros((0, 5), np.int64)
        self.keys = np.zeros(0, np.int64)

    def split(self, texts: list[str]) -> list[list[str]]:
        """The chunks of each text, which are known from here on."""
        if len(self.rows) > MAX_CHUNKS or self.chars > MAX_CHARS:
            self.clear()
        parts = [CUT.split(t) if self.s.parted else [t] for t in texts]
        new = [c for c in dict.fromkeys(c for part in parts for c in part) if c not in self.rows]
        if new:
            self._learn(new)
        return parts

    def _learn(self, new: list[str]) -> None:
        s = self.s
        sides = _encoded(s, new)
        sizes = [np.array([len(i) for i in ids], np.int64) for ids in sides]
        ids = [np.array([i for some in side for i in some], np.int64) for side in sides]
        spelt = [(" " + c).encode() for c in new]
        whole = np.array([len(x) for x in spelt], np.int64)
        good = np.ones(len(new), bool)
        for i, n, length in zip(ids, sizes, (s.a_len, s.b_len), strict=True):
            good &= np.bincount(_owners(n), weights=length[i], minlength=len(new)) == whole
        data = np.frombuffer(b"".join(spelt), np.uint8)
        at = _owners(whole)
        for i, n, flat in zip(
            ids, sizes, ((s.a_flat, s.a_start, s.a_len), (s.b_flat, s.b_start, s.b_len)), strict=True
        ):
            kept = good[at]
            wrong = spelled(*flat, i[good[_owners(n)]]) != data[kept]
            good &= np.bincount(at[kept], weights=wrong, minlength=len(new)) == 0
        (a, b), (n_a, n_b) = (i[good[_owners(n)]] for i, n in zip(ids, sizes)), (n[good] for n in sizes)
        a_group, b_group, at_a, at_b = coalesce(a, s.a_len[a], b, s.b_len[b])
        # Each chunk ends with a cut, so its last token closes its last group.
        closing = a_group[np.cumsum(n_a) - 1]
        last = np.zeros(int(closing[-1]) + 1 if len(closing) else 0, bool)
        last[closing] = True
        counts = np.zeros((len(new), 5), np.int64)
        counts[:, 4] = ~good
        counts[good, 0], counts[good, 1] = n_a, n_b
        counts[good, 2] = np.diff(closing, prepend=-1)
        counts[good, 3] = np.bincount(_owners(n_a)[at_a], minlength=len(n_a))
        lines = iter(groups_text(a, a_group, b, b_group, last).split(b"\n"))
        self.texts += [next(lines) if g else b"" for g in good.tolist()]
        self.counts = np.concatenate([self.counts, counts])
        self.keys = np.concatenate([self.keys, (a[at_a] << 32) | b[at_b]])
        self.first = np.cumsum(self.counts[:, 3]) - self.counts[:, 3]
        for chunk in new:
            self.rows[chunk] = len(self.rows)
            self.chars += len(chunk)

    def document(self, parts: list[str]) -> tuple | None:
        """As ``_document`` for the text of these chunks; None if a chunk's bytes are not given back."""
        rows = [self.rows[c] for c in parts]
        n_a, n_b, n_groups, n_links, bad = self.counts[rows].sum(axis=0).tolist()
        if bad:
            return None
        digest = hashlib.sha256(b";".join([self.texts[r] for r in rows])).hexdigest()
        distinct, times = np.unique(rows, return_counts=True)
        links = self.counts[distinct, 3]
        begin = np.cumsum(links) - links
        held = self.keys[np.repeat(self.first[distinct] - begin, links) + np.arange(links.sum())]
        keys, inverse = np.unique(held, return_inverse=True)
        n = np.bincount(inverse, weights=np.repeat(times, links), minlength=len(keys)).astype(np.int64)
        return n_a, n_b, n_groups, n_links, digest, keys >> 32, keys & 0xFFFFFFFF, n


def _documents(s: Sides, texts: list[str]) -> list[tuple]:
    docs = [s.chunks.document(p) if t else NOTHING for t, p in zip(texts, s.chunks.split(texts), strict=True)]
    rest = [k for k, doc in enumerate(docs) if doc is None]
    whole = [texts[k] for k in rest]
    for k, text, a, b in zip(rest, whole, *_encoded(s, whole), strict=True):
        docs[k] = _document(s, text, np.array(a, np.int64), np.array(b, np.int64))
    return docs


def _aligner(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(a_path, b_path)
        for frame in batches:
            for start in range(0, frame.num_rows, BATCH):
                part = frame.slice(start, BATCH)
                texts = [t or "" for t in part.column("text").to_pylist()]
                yield _batch(part.column("doc_id"), _documents(s, texts))

    return run


def _batch(doc_ids: pa.Array, docs: list[tuple]) -> pa.RecordBatch:
    counts = [pa.array([d[k] for d in docs], pa.int64()) for k in range(4)]
    digests = pa.array([d[4] for d in docs], pa.string())
    sizes = np.array([len(d[5]) for d in docs], np.int64)
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    flat = [np.concatenate([d[k] for d in docs]) if docs else np.zeros(0, np.int64) for k in (5, 6, 7)]
    pairs = pa.StructArray.from_arrays(
        [pa.array(flat[0].astype(np.int32)), pa.array(flat[1].astype(np.int32)), pa.array(flat[2].astype(np.int64))],
        ["a", "b", "n"],
    )
    return pa.RecordBatch.from_arrays(
        [doc_ids.cast(pa.int64()), *counts, digests, pa.ListArray.from_arrays(offsets, pairs)],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
    )


NOTHING = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _document(s: Sides, text: str, a_ids: np.ndarray, b_ids: np.ndarray) -> tuple:
    """Counts, digest and the distinct linked (A id, B id) pairs with their multiplicity."""
    whole = np.frombuffer((" " + text).encode(), np.uint8)
    if (
        not text
        or int(s.a_len[a_ids].sum()) != len(whole)
        or int(s.b_len[b_ids].sum()) != len(whole)
        or not np.array_equal(spelled(s.a_flat, s.a_start, s.a_len, a_ids), whole)
        or not np.array_equal(spelled(s.b_flat, s.b_start, s.b_len, b_ids), whole)
    ):
        return NOTHING
    a_group, b_group, at_a, at_b = coalesce(a_ids, s.a_len[a_ids], b_ids, s.b_len[b_ids])
    n_groups = int(a_group[-1]) + 1
    digest = hashlib.sha256(groups_text(a_ids, a_group, b_ids, b_group)).hexdigest()
    keys, n = np.unique((a_ids[at_a] << 32) | b_ids[at_b], return_counts=True)
    return len(a_ids), len(b_ids), n_groups, len(at_a), digest, keys >> 32, keys & 0xFFFFFFFF, n


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aligned = src.mapInArrow(_aligner(a_path, b_path), OUT).withColumn("row", F.monotonically_increasing_id())
    aligned = written(aligned, "align-docs")
    links = aligned.select("row", F.inline("pairs"))
    counts = links.groupBy("a", "b").agg(F.sum("n").alias("count"))
    best = counts.groupBy("b").agg(F.max("count").alias("best"))
    counts = written(
        counts.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("best")).alias("is_best")),
        "align-counts",
    )
    small = broadcast_if_small(counts, PAIR_ROW_BYTES)
    if small is not counts:
        joined = links.join(small, ["a", "b"])
    else:
        # A common pair may hold a large share of all links: its rows are spread over salts.
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = links.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(
            salted, ["a", "b", "salt"]
        )
    per_doc = joined.groupBy("row").agg(
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("n_best"),
    )
    out = aligned.join(per_doc, "row", "left")
    return out.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )


ship(__name__)
