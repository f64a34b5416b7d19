"""Language-model scores by a probabilistic suffix tree (dealt operator 6).

Words are spelled as UTF-8 bytes (A-Z in lower case) with a separator behind
each, and a text closes with an end sign, so any text has a probability and no
word is unknown. The tree holds contexts of up to ``DEPTH`` bytes. A context
stays if its next-byte distribution diverges from that of its suffix by more
than a likelihood test allows for the symbols it adds. A state's distribution
is smoothed by the next shorter one (Witten-Bell), down to a uniform one; each
byte is scored from its longest state.

Counting covers all training texts, in one pass, with partial counts in each
task. The tree holds every state that the test keeps, so it grows with the
texts. It is sent in blocks of some ``ENTRIES`` transitions: ranges of contexts
read backwards, which hold all states that a gram can need. A task takes a chunk
of its texts through one block after the other and holds one block at a time.
Word counts for the unigram base are joined: the ``FREQUENT`` most frequent words
are sent to all tasks, all others by a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import ship, written
from docflow.llm.words import SLICE, byte_tables, cut, flat, groups, hash_spans, spans

DEPTH = 6
ENTRIES = 3_000_000
FREQUENT = 1_000_000
SYMBOLS = 256 - 6 + 2
SEPARATOR, CLOSE = 32, 10
WORD, GRAM, CLOSED = 0, 1, 2
HELD_COUNTS = 1 << 20
CHUNK = 1 << 23


def spell(data: np.ndarray, edges: np.ndarray, lead: np.ndarray, close: bool) -> tuple:
    """Symbols of texts, each behind ``lead``; which text each belongs to; which are not lead; word hashes, owners."""
    _, lower = byte_tables()
    starts, ends = spans(data, edges)
    n = len(edges) - 1
    owner = np.searchsorted(edges, starts, "right") - 1
    lengths = ends - starts
    size = np.bincount(owner, weights=lengths + 1, minlength=n).astype(np.int64) + len(lead) + close
    begin = np.cumsum(size) - size
    symbols = np.full(size.sum(), SEPARATOR, np.uint8)
    for k, sign in enumerate(lead):
        symbols[begin + k] = sign
    if close:
        symbols[begin + size - 1] = CLOSE
    if len(starts):
        # Words follow one another within a text, a separator behind each.
        run = np.cumsum(lengths + 1) - (lengths + 1)
        words = np.bincount(owner, minlength=n)
        first = np.cumsum(words) - words
        base = begin[owner] + len(lead) - run[first[owner]]
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        symbols[np.repeat(base + run, lengths) + place] = lower[data[np.repeat(starts, lengths) + place]]
    scored = np.ones(len(symbols), bool)
    for k in range(len(lead)):
        scored[begin + k] = False
    return symbols, np.repeat(np.arange(n), size), scored, hash_spans(data, starts, ends), owner


def gram_keys(symbols: np.ndarray) -> np.ndarray:
    """DEPTH + 1 symbols that end at each place, packed into a number; the first DEPTH places are void."""
    keys = np.zeros(len(symbols), np.uint64)
    for back in range(DEPTH, -1, -1):
        shifted = np.zeros(len(symbols), np.uint64)
        shifted[back:] = symbols[: len(symbols) - back]
        keys = (keys << np.uint64(8)) | shifted
    return keys


def turned(keys: np.ndarray) -> np.ndarray:
    """Grams with their bytes read backwards, the last symbol first; of turned ones, the grams."""
    return keys.byteswap()


def spelled(column: pa.Array) -> Iterator[tuple]:
    """For runs of texts: (first, last + 1, gram keys, their texts, word hashes, their texts).

    A text longer than a slice comes in several such runs.
    """
    data, offsets = flat(column)
    blank = np.full(DEPTH, CLOSE, np.uint8)
    for i, j in groups(offsets, SLICE):
        part = data[offsets[i] : offsets[j]]
        if j == i + 1 and len(part) > SLICE:
            lead = blank
            for a, b in cut(part, SLICE):
                symbols, owner, scored, words, of = spell(part[a:b], np.array([0, b - a]), lead, b == len(part))
                yield i, j, gram_keys(symbols)[scored], owner[scored], words, of
                lead = symbols[-DEPTH:]
        else:
            symbols, owner, scored, words, of = spell(part, offsets[i : j + 1] - offsets[i], blank, True)
            yield i, j, gram_keys(symbols)[scored], owner[scored], words, of


class Counter:
    """Counts of 64-bit keys, given away whenever they take too much room."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.held = kind, [], 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.held += len(self.parts[-1][0])

    def merge(self) -> None:
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        kept, inverse = np.unique(keys, return_inverse=True)
        self.parts = [(kept, np.bincount(inverse, weights=counts).astype(np.int64))]
        self.held = len(kept)

    def batch(self) -> pa.RecordBatch:
        keys, counts = self.parts[0]
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(keys), self.kind, np.int32)),
                pa.array(keys.view(np.int64)),
                pa.array(counts),
            ],
            ["kind", "key", "n"],
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters = [Counter(WORD), Counter(GRAM)]
    texts = 0
    for batch in batches:
        texts += batch.num_rows
        for _, _, keys, _, words, _ in spelled(batch.column(0)):
            for counter, some in zip(counters, (words, keys), strict=True):
                if len(some):
                    counter.add(some)
                if counter.held > 2 * HELD_COUNTS:
                    counter.merge()
                    if counter.held > HELD_COUNTS:
                        yield counter.batch()
    for counter in counters:
        if counter.parts:
            counter.merge()
            yield counter.batch()
    row = [pa.array([CLOSED], pa.int32()), pa.array([0], pa.int64()), pa.array([texts], pa.int64())]
    yield pa.RecordBatch.from_arrays(row, ["kind", "key", "n"])


def least_count(counts: DataFrame, room: int) -> int | None:
    """The least count such that rows of it and above number ``room`` at most; None if there is none."""
    # Distinct counts are few next to the rows, and reading stops at the bound.
    heights = counts.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("n"))
    least = None
    for row in heights.toLocalIterator():
        room -= row["rows"]
        if room < 0:
            break
        least = row["n"]
    return least


def _diverging(moves: DataFrame, states: DataFrame, shorter: DataFrame, shorter_states: DataFrame, length: int):
    """The states whose transitions gain more likelihood over their suffix's than their symbols cost."""
    suffix = F.col("context").bitwiseAND(F.lit((1 << 8 * (length - 1)) - 1))
    suffix_move = F.col("move").bitwiseAND(F.lit((1 << 8 * length) - 1))
    own = moves.join(states, "context").withColumns({"suffix": suffix, "suffix_move": suffix_move})
    old = shorter.select(F.col("move").alias("suffix_move"), F.col("n").alias("n_old"))
    old_states = shorter_states.select(F.col("context").alias("suffix"), F.col("all").alias("all_old"))
    own = own.join(old, "suffix_move").join(old_states, "suffix")
    ratio = (F.col("n") / F.col("all")) / (F.col("n_old") / F.col("all_old"))
    tested = own.groupBy("context", "all", "kinds").agg(F.sum(F.col("n") * F.log(ratio)).alias("gain"))
    return tested.where(F.col("gain") >= 0.5 * F.col("kinds") * F.log(F.col("all"))).drop("gain")


def places(context: Column) -> Column:
    """A context read backwards, its last byte first, as a number of ``DEPTH`` bytes.

    In this order a context stands before all longer ones that end with it.
    """
    byte = [F.shiftright(context, 8 * k).bitwiseAND(F.lit(255)) for k in range(DEPTH)]
    return sum((F.shiftleft(b, 8 * (DEPTH - 1 - k)) for k, b in enumerate(byte)), F.lit(0).cast("long"))


def grow(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(length, place, context, back) of all states, (length, place, move, share) of all their transitions."""
    levels: list[tuple[DataFrame, DataFrame]] = []
    moves = grams.select(F.col("key").alias("move"), "n")
    for length in range(DEPTH, -1, -1):
        # Counts of a shorter length are sums of those of the longer one.
        mask = F.lit((1 << 8 * (length + 1)) - 1)
        moves = moves.groupBy(F.col("move").bitwiseAND(mask).alias("move")).agg(F.sum("n").alias("n"))
        moves = written(moves.withColumn("context", F.shiftright("move", 8)), "moves")
        states = moves.groupBy("context").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        levels.insert(0, (moves, written(states, "states")))
    backs, shares = [], []
    weight = F.col("all") + F.col("kinds")
    for length, (moves, states) in enumerate(levels):
        if length:
            states = written(_diverging(moves, states, *levels[length - 1], length), "kept")
        at = (F.lit(length).alias("length"), places(F.col("context")).alias("place"))
        backs.append(states.select(*at, "context", (F.col("kinds") / weight).alias("back")))
        shares.append(moves.join(states, "context").select(*at, "move", (F.col("n") / weight).alias("share")))
    return tuple(written(reduce(DataFrame.unionAll, x), name) for x, name in ((backs, "backs"), (shares, "shares")))


def collected(backs: DataFrame, shares: DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each context length: contexts, their back-off weights, transitions, their shares.

    Contexts and transitions are ``turned`` and in that order.
    """
    halves = []
    for df, key, value in ((backs, "context", "back"), (shares, "move", "share")):
        found = df.select("length", key, value).toArrow()
        length, keys, values = (found.column(c).to_numpy() for c in range(3))
        keys = turned(keys.astype(np.uint64))
        order = np.lexsort((keys, length))
        edges = np.searchsorted(length[order], np.arange(DEPTH + 2))
        parts = [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        halves.append([(keys[part], values[part]) for part in parts])
    return [(*back, *share) for back, share in zip(*halves, strict=True)]


def grow_tree(grams: DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The tree in one piece, for counts that are few."""
    return collected(*grow(grams))


def block_starts(shares: DataFrame) -> list[int]:
    """The places from which blocks of some ``ENTRIES`` transitions reach up to the next; the first is 0."""
    n = -(-shares.count() // ENTRIES)
    if n < 2:
        return [0]
    # Ranks are off by a 100,000th of all transitions; those of one place are some thousand at most.
    ranks = [k / n for k in range(1, n)]
    return [0, *sorted(set(shares.agg(F.percentile_approx("place", ranks, 100_000)).first()[0]) - {0})]


def tree_blocks(backs: DataFrame, shares: DataFrame, starts: list[int]) -> Iterator[list]:
    """The levels of each block: its range of places, and what the first place in it goes back to."""
    for start, end in zip(starts, [*starts[1:], 1 << 8 * DEPTH], strict=True):
        suffixes = sorted({start >> 8 * k << 8 * k for k in range(DEPTH + 1)})
        inside = F.col("place").between(start, end - 1) | F.col("place").isin(suffixes)
        yield collected(backs.where(inside), shares.where(inside))


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def gram_log10(levels: list, keys: np.ndarray) -> np.ndarray:
    """log10 probability of the last symbol of each gram after those before it.

    Fastest in the order of ``turned``: grams of one suffix follow one another
    there, and each suffix is looked up once.
    """
    back_first = turned(keys)
    if (back_first[1:] < back_first[:-1]).any():
        order = np.argsort(back_first)
        out = np.empty(len(keys))
        out[order] = gram_log10(levels, keys[order])
        return out
    p, of = np.full(1, 1.0 / SYMBOLS), np.zeros(len(keys), np.int64)
    opens = np.zeros(len(keys), bool)
    opens[:1] = True
    for length, (contexts, back, moves, share) in enumerate(levels):
        rest = np.uint64(8 * (7 - length))
        part = back_first >> rest
        opens[1:] |= part[1:] != part[:-1]
        first = np.flatnonzero(opens)
        move = part[first] << rest
        # Without a state of this length the shorter one stays the longest.
        p = look_up(contexts, back, move << np.uint64(8), 1.0) * p[of[first]] + look_up(moves, share, move, 0.0)
        of = np.cumsum(opens) - 1
    return np.log10(p)[of]


def key_places(keys: np.ndarray) -> np.ndarray:
    """``places`` of the contexts of grams."""
    place = np.zeros(len(keys), np.uint64)
    for k in range(DEPTH):
        byte = (keys >> np.uint64(8 * (k + 1))) & np.uint64(255)
        place |= byte << np.uint64(8 * (DEPTH - 1 - k))
    return place.astype(np.int64)


def blocked_log10(starts: list[int], blocks: list[Callable[[], list]], keys: np.ndarray) -> np.ndarray:
    """``gram_log10`` over all blocks, of which one is held at a time."""
    if len(blocks) == 1:
        return gram_log10(blocks[0](), keys)
    at = np.searchsorted(starts, key_places(keys), "right") - 1
    out = np.zeros(len(keys))
    for k, load in enumerate(blocks):
        # Grams stay in their order.
        some = np.flatnonzero(at == k)
        if len(some):
            out[some] = gram_log10(load(), keys[some])
    return out


def _read(shared: Broadcast, hold: bool) -> list:
    """The value of a broadcast; unless ``hold``, the worker reads it from its file each time."""
    value = shared.value
    if not hold and getattr(shared, "_path", None) is not None:
        vars(shared).pop("_value", None)
    return value


SCORED = (
    "row long, doc_id long, learned boolean, words long, known long, base double, score double, rare array<long>"
)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys there are, in order, and which of them each is."""
    order = np.argsort(keys)
    ranked = keys[order]
    opens = np.ones(len(keys), bool)
    opens[1:] = ranked[1:] != ranked[:-1]
    of = np.empty(len(keys), np.int32)
    of[order] = np.cumsum(opens, dtype=np.int32) - 1
    return ranked[opens], of


def settle(held: list[tuple], score: np.ndarray, starts: list[int], blocks: list[Callable[[], list]]) -> None:
    """Add the grams, ``turned``, of ``held`` runs of texts to the scores of these."""
    if not held:
        return
    every = held[0][2] if len(held) == 1 else np.unique(np.concatenate([kinds for _, _, kinds, _, _ in held]))
    values = blocked_log10(starts, blocks, turned(every))
    for i, j, kinds, inverse, owner in held:
        value = (values if len(held) == 1 else values[np.searchsorted(every, kinds)])[inverse]
        score[i:j] += np.bincount(owner, weights=value, minlength=j - i)


def _score(model: Callable[[], tuple]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        starts, blocks, frequent, logs = model()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n = batch.num_rows
            score, base = np.zeros(n), np.zeros(n)
            words_in, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
            rare: list[list[np.ndarray]] = [[] for _ in range(n)]
            held: list[tuple] = []
            for i, j, keys, owner, words, of in spelled(batch.column(2)):
                held.append((i, j, *distinct(turned(keys)), owner.astype(np.int32)))
                if len(blocks) == 1 or sum(len(h[3]) for h in held) >= CHUNK:
                    settle(held, score, starts, blocks)
                    held = []
                words_in[i:j] += np.bincount(of, minlength=j - i)
                if not len(words):
                    continue
                value = look_up(frequent, logs, words.view(np.int64), np.nan)
                often = ~np.isnan(value)
                base[i:j] += np.bincount(of[often], weights=value[often], minlength=j - i)
                known[i:j] += np.bincount(of[often], minlength=j - i)
                left, left_of = words[~often], of[~often]
                edges = np.searchsorted(left_of, np.arange(j - i + 1))
                for d in np.flatnonzero(np.diff(edges)):
                    rare[i + d].append(left[edges[d] : edges[d + 1]])
            settle(held, score, starts, blocks)
            lists = [np.concatenate(r) if r else np.zeros(0, np.uint64) for r in rare]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
            flat_rare = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)),
                    batch.column(0),
                    batch.column(1),
                    pa.array(words_in),
                    pa.array(known),
                    pa.array(base),
                    pa.array(score),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat_rare.view(np.int64))),
                ],
                [f.split()[0] for f in SCORED.split(", ")],
            )
            row += n

    return run


def score_texts(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all texts by a tree, and a unigram base, learned from the rows where ``learn`` holds.

    Columns: ``doc_id``, ``learned``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` and
    ``score``, both log10. A null text is empty and is scored as its end sign
    alone. A null ``learn`` is false. Equal rows are scored and counted as often
    as they occur; null ids stay null; other columns are ignored. Without
    training rows the tree is a uniform distribution and nothing is known; an
    empty table gives no rows.
    """
    spark = df.sparkSession
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learned"),
        F.col(text_col).alias("text"),
    )
    counted = docs.where("learned").select("text").mapInArrow(_count, "kind int, key long, n long")
    counted = written(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    sums = counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    n_of, v_of = {r["kind"]: r["n"] for r in sums}, {r["kind"]: r["v"] for r in sums}
    closes = n_of.get(CLOSED, 0)
    tokens = n_of.get(WORD, 0) + closes
    kinds = v_of.get(WORD, 0) + (closes > 0)
    scale = tokens + 0.1 * (kinds + 1)
    starts, blocks = [0], [[]]
    if closes:
        backs, shares = grow(counted.where(F.col("kind") == GRAM))
        starts = block_starts(shares)
        blocks = tree_blocks(backs, shares, starts)
    # A block is sent before the next one is collected.
    sent = [spark.sparkContext.broadcast(block) for block in blocks]

    words = counted.where(F.col("kind") == WORD).select(F.col("key").alias("word"), "n")
    least = least_count(words.select("n"), FREQUENT)
    often = words.where(F.col("n") >= (least if least is not None else F.lit(None))).toArrow().sort_by("word")
    frequent = np.ascontiguousarray(often.column(0).to_numpy())
    logs = np.log10((often.column(1).to_numpy() + 0.1) / scale)
    shared = spark.sparkContext.broadcast((frequent, logs))
    hold = len(sent) == 1

    def model() -> tuple:
        return starts, [partial(_read, block, hold) for block in sent], *shared.value

    scored = written(docs.mapInArrow(_score(model), SCORED), "scored")

    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("m"))
    rest = words.where(F.col("n") < least) if least is not None else words
    met = rare.join(rest, "word", "left")
    per_row = met.groupBy("row").agg(
        F.sum(F.col("m") * F.log10((F.coalesce("n", F.lit(0)) + 0.1) / scale)).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("m")).otherwise(0)).alias("met"),
    )
    close = float(np.log10((closes + 0.1) / scale))
    return scored.join(per_row, "row", "left").select(
        "doc_id",
        "learned",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("met", F.lit(0)) + F.lit(int(closes > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(close)).alias("base_score"),
        "score",
    )


ship(__name__)
