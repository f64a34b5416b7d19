"""Word hashes of whole Arrow text columns, vectorised over documents.

A word is a run of bytes other than 0x20 and 0x09-0x0D, with A-Z in lower
case. Null texts have no words. Texts of any length are worked off in slices
of about ``SLICE`` bytes, cut between words, so memory does not follow the
longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docflow.llm.common import ship

SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are white space; each byte in lower case."""
    white = np.zeros(256, bool)
    white[[9, 10, 11, 12, 13, 32]] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return white, lower


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another and the n + 1 offsets; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a word never crosses an offset."""
    white, _ = byte_tables()
    gap = white[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    start = ~gap & (before | edge[:-1])
    end = ~gap & (after | edge[1:])
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's lower-cased bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _, lower = byte_tables()
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(lengths.max(), BASE, np.uint64))
        value = lower[data[place + np.repeat(starts, lengths)]].astype(np.uint64) + np.uint64(1)
        return mix(np.add.reduceat(value * powers[place], first) + lengths.astype(np.uint64))


def cut(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Slices of about ``size`` bytes that end behind white space or at the end."""
    white, _ = byte_tables()
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and not white[data[end - 1]]:
            gaps = np.flatnonzero(white[data[end : end + size]])
            end = end + int(gaps[0]) + 1 if len(gaps) else min(end + size, len(data))
        yield at, end
        at = end


def groups(offsets: np.ndarray, size: int = SLICE, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``size`` bytes together, one document at least and ``most`` at most."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        end = min(end, at + (most or end))
        yield at, end
        at = end


def hashed(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of documents: first, last + 1, hashes of their words, words per document."""
    data, offsets = flat(column)
    for i, j in groups(offsets, size):
        part, edges = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if j == i + 1 and len(part) > size:
            hashes = [
                hash_spans(part[a:b], *spans(part[a:b], np.array([0, b - a]))) for a, b in cut(part, size)
            ]
            hashes = np.concatenate(hashes)
            yield i, j, hashes, np.array([len(hashes)])
        else:
            starts, ends = spans(part, edges)
            owner = np.searchsorted(edges, starts, "right") - 1
            yield i, j, hash_spans(part, starts, ends), np.bincount(owner, minlength=j - i)


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each document.

    With fewer words than ``width`` the whole sequence is one shingle; without
    words the set is empty.
    """
    first = np.concatenate(([0], np.cumsum(counts)))
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for k in range(width):
            rolled = mix(rolled + hashes[k : k + len(rolled)] + np.uint64(k + 1))
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = np.uint64(0xD6E8FEB86659FD93)
            for h in hashes[a:b]:
                with np.errstate(over="ignore"):
                    short = mix(np.atleast_1d(short + h))[0]
            out.append(np.array([short], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


ship(__name__)
