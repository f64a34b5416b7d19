"""MinHash near-duplicates by one-permutation hashing (dealt operator 5).

One hash of each shingle gives both its bin and its value; the least value of a
bin is the bin's minimum, and empty bins borrow from bins picked by a hash of
bin and attempt ("optimal densification", Shrivastava 2017). Bands of bins make
buckets. A bucket of n sets gives n - 1 candidate edges, from one centre to the
others; edges are confirmed on the full sets. The centre is the set that shares
most buckets, which of edited copies is the one least edited.

Sets of buckets that still hold several components are compared by their shingles,
without hashing: only shingles that occur in several components can be in common, and
a pair at the threshold meets in the rarest of them (a prefix filter). Buckets of these that are
large are parted by what sets their members apart from one centre. Pairs that the sizes,
or the shingles left behind the one they met in, rule out are never made. So no candidate is
dropped, and pair counts stay near the number of bucket members.

Documents with equal sets are one class from the start: only a class's least
document enters buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.llm.common import broadcast_if_small, ship, short_batches, written
from docflow.llm.graph import joined_components
from docflow.llm.words import hashed, mix, shingle_sets

Texts = Callable[[DataFrame], DataFrame]

ROWS_PER_BAND = 5
# Chance to miss a pair at the threshold in every band.
MISS = 1e-7
# Signature bins held at once, so that memory does not follow the number of bands.
HELD_BINS = 1 << 19
# Buckets of so many members are compared pair by pair at once; larger ones are parted so many times before.
SMALL, PARTINGS = 8, 1
# Bounds in floating point are lowered by this.
SLACK = 1e-6
# Files of a written table for each core at most: of those made of ids, of those made of whole sets.
SLIM, WIDE = 4, 8
SKETCH = "doc_id long, part long, n_shingles long, set_a long, set_b long, buckets array<long>"


def bands_for(percent: int, rows: int) -> int:
    """Bands needed so that a pair at the threshold meets in one with chance 1 - MISS."""
    meet = (percent / 100) ** rows
    return 1 if meet >= 1 else math.ceil(math.log(MISS) / math.log1p(-meet))


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One-permutation minima of non-empty sorted sets, empty bins densified."""
    out = np.zeros((len(sets), bins), np.uint64)
    full = np.zeros((len(sets), bins), bool)
    for row, values in enumerate(sets):
        bin_of = ((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], bin_of[1:] != bin_of[:-1])))
        out[row, bin_of[first].astype(np.int64)] = values[first]
        full[row, bin_of[first].astype(np.int64)] = True
    row, slot = np.nonzero(~full)
    attempt = 0
    while len(row):
        attempt += 1
        with np.errstate(over="ignore"):
            seed = slot.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019) + np.uint64(attempt)
        donor = ((mix(seed) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        found = full[row, donor]
        out[row[found], slot[found]] = out[row[found], donor[found]]
        row, slot = row[~found], slot[~found]
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit bucket for each band of each row."""
    rows = signature.shape[1] // bands
    parts = signature.reshape(len(signature), bands, rows)
    keys = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), 1))
    for k in range(rows):
        with np.errstate(over="ignore"):
            keys = mix(keys * np.uint64(3) + parts[:, :, k])
    return keys


def _as_lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sketch(width: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, counts in hashed(batch.column(1)):
                sets = shingle_sets(hashes, counts, width)
                with np.errstate(over="ignore"):
                    one = [s.sum(dtype=np.uint64) for s in sets]
                    two = [mix(s ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64) for s in sets]
                some = [r for r, s in enumerate(sets) if len(s)]
                keys: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(sets)
                step = max(1, HELD_BINS // (bands * rows))
                for at in range(0, len(some), step):
                    part = some[at : at + step]
                    made = band_keys(signatures([sets[r] for r in part], bands * rows), bands)
                    for r, k in zip(part, made, strict=True):
                        keys[r] = k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(2).slice(i, j - i),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array(one, np.uint64).view(np.int64)),
                        pa.array(np.array(two, np.uint64).view(np.int64)),
                        _as_lists(keys),
                    ],
                    ["doc_id", "part", "n_shingles", "set_a", "set_b", "buckets"],
                )

    return run


def _sets(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, hashes, counts in hashed(batch.column(1)):
                sets = _as_lists(shingle_sets(hashes, counts, width))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), sets], ["node", "shingles"])

    return run


def _texts_by_id(docs: DataFrame) -> Texts:
    """Finds the texts of nodes that are ids; texts stay in place as long as few enough nodes are sent to them."""

    def find(nodes: DataFrame) -> DataFrame:
        named = written(nodes.select(F.col(nodes.columns[0]).alias("doc_id")).distinct(), "nodes", SLIM)
        return docs.join(broadcast_if_small(named, 16), "doc_id", "left_semi").select("doc_id", "text")

    return find


def _texts_by_class(docs: DataFrame, classes: DataFrame, repeated: bool) -> Texts:
    """The same for nodes that are classes: of each, one text of the first row."""

    def find(nodes: DataFrame) -> DataFrame:
        nodes = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct()
        named = written(classes.select("node", "doc_id", "part").join(nodes, "node"), "nodes", SLIM)
        found = docs.join(broadcast_if_small(named, 40), ["doc_id", "part"]).select("node", "text")
        return found.dropDuplicates(["node"]) if repeated else found

    return find


def _sets_of(nodes: DataFrame, texts: Texts, width: int) -> DataFrame:
    """(of, node, shingles): the sets of some nodes. Rows that repeat an id are sets of their own, told by ``of``."""
    sets = texts(nodes).mapInArrow(_sets(width), "node long, shingles array<long>")
    return written(sets.withColumn("of", F.monotonically_increasing_id()), "sets", WIDE)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = F.size("set_a") + F.size("set_b") - common
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.where(100 * common >= percent * both).select("a", "b").distinct()


def _rarest(held: DataFrame, group: list[str], need: Column) -> DataFrame:
    """Of the shingles of each set, those that some set of another component holds too, the rarest first.

    ``held`` has the columns of ``group``, ``of``, ``comp`` and ``shingle``. A pair of
    sets that has ``need`` of these in common, a bound of either set, meets in the first
    ``most - need + 1`` of one and those of the other, as all are in one order;
    ``most`` is how many a set has.
    """
    key = [*group, "shingle"]
    spread = held.groupBy(*key).agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("by"))
    shared = held.join(spread.where("low != high").drop("low", "high"), key)
    own = Window.partitionBy(*group, "of")
    ranked = shared.withColumns(
        {"most": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("by", "shingle"))}
    )
    ranked = ranked.withColumn("left", F.col("most") - F.col("rank") + 1)
    return ranked.where(F.col("left") >= need)


def _rarest_shared(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Members of a bucket for each of the rarest shingles of each set that a set of another component has too.

    ``n`` is the size of a set; ``most``, how many of its shingles occur in other
    components, bounds what it has in common with a set of one. A pair at the
    threshold has ``percent`` of either set in common.
    """
    n = F.size("shingles").alias("n")
    held = written(sets.join(nodes, "node").select("of", "node", "comp", n, F.explode("shingles").alias("shingle")), "held", WIDE)
    first = _rarest(held, [], F.ceil(F.lit(percent) * F.col("n") / 100 - SLACK))
    bucket = F.col("shingle").alias("bucket")
    return written(first.select(bucket, "of", "node", "n", F.col("n").alias("d"), "most", "left"), "members", SLIM)


def _parted(members: DataFrame, hubs: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members of large buckets in buckets of what sets them apart from the hub of theirs.

    The hub was compared with all of them. If the sets a and b are linked and b and the
    hub are not, a and b have in common that they differ from the hub in some shingle:
    otherwise |a ^ b| = |a ^ hub| + |b ^ hub|, and b is too far from the hub for that.
    The least number of such shingles follows from the sizes alike. All buckets of a hub
    are parted at once.
    """
    far = (100 - percent) / (100 + percent)
    hubs = hubs.select("bucket", F.col("node").alias("hub"))
    around = members.join(hubs, "bucket").select("of", "node", "n", "comp", "hub").distinct()
    names = comps.withColumnRenamed("component", "comp")
    cores = sets.join(hubs.select(F.col("hub").alias("node")).distinct(), "node").join(names, "node", "left").select(
        F.col("of").alias("core"), F.col("node").alias("hub"), F.col("shingles").alias("of_hub"),
        F.coalesce("comp", "node").alias("comp_hub"),
    )
    apart = F.concat(F.array_except("of_hub", "shingles"), F.array_except("shingles", "of_hub"))
    held = around.join(cores, "hub").join(sets.select("of", "shingles"), "of")
    held = held.withColumns({"n_hub": F.size("of_hub"), "apart": apart}).select(
        "core", "of", "node", "n", "comp", "comp_hub", "n_hub", F.size("apart").alias("d"),
        F.explode("apart").alias("shingle"),
    )
    held = written(held, "held", WIDE)
    d, n = F.col("d"), F.col("n")
    to_far = (d - far * (n - F.col("n_hub"))) / 2
    to_near = d - far * n * (1 + 100 / percent)
    need = F.when(F.col("comp") == F.col("comp_hub"), to_far).otherwise(F.least(to_far, to_near))
    first = _rarest(held, ["core"], F.greatest(F.ceil(need - SLACK), F.lit(1)))
    bucket = F.xxhash64("core", "shingle").alias("bucket")
    return written(first.select(bucket, "of", "node", "n", "d", "most", "left"), "members", SLIM)


def _members(sketched: DataFrame) -> DataFrame:
    """(bucket, node, n, most) of buckets with two members at least, from (node, n, most, buckets)."""
    every = sketched.select(F.explode("buckets").alias("bucket"), "node", "n", "most")
    shared = every.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    return written(every.join(shared, "bucket"), "members", SLIM)


def _candidates(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of a centre and another member of its bucket that may be similar enough.

    Of ``n`` shingles of a set, ``d`` are told apart, and of these ``most`` at most are
    those of another set too; ``left`` of them do not come before the bucket's. A pair is
    looked for in the bucket of the first it has in common, but with a ``hub`` in any.
    """
    c = centres.select("bucket", "hub", *(F.col(x).alias(f"{x}_c") for x in ("node", "n", "d", "most", "left", "comp")))
    pairs = members.join(c, "bucket").where("node != node_c AND comp != comp_c")
    common = F.when(F.col("hub"), F.least("most", "most_c")).otherwise(F.least("left", "left_c"))
    both = F.col("n") + F.col("n_c")
    pairs = pairs.where((100 + percent) * (both - F.col("d") - F.col("d_c") + 2 * common) >= 2 * percent * both)
    return pairs.select(F.least("node", "node_c").alias("a"), F.greatest("node", "node_c").alias("b")).distinct()


def _hubs(members: DataFrame) -> DataFrame:
    """The member of each bucket that has the most company in all its buckets."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    company = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("company"))
    best = F.max(F.struct("company", (-F.col("node")).alias("rank"), "n", "most")).alias("m")
    ranked = members.join(company, "node").groupBy("bucket").agg(best)
    node = -F.col("m.rank")
    return ranked.select("bucket", node.alias("node"), "m.n", "m.most", node.alias("comp"))


def _open(members: DataFrame, centres: DataFrame, comps: DataFrame) -> DataFrame:
    """Members, but for centres, of buckets that hold several components still."""
    # Centres have met all others of their bucket by now.
    used = centres.select("bucket", "node")
    names = comps.withColumnRenamed("component", "comp")
    left = members.drop("comp", "size").join(used, ["bucket", "node"], "left_anti").join(names, "node", "left")
    left = left.withColumn("comp", F.coalesce("comp", "node"))
    several = left.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    several = several.where("low != high").select("bucket", "size")
    return written(left.join(several, "bucket"), "members", SLIM)


def _centres(members: DataFrame, small: int | None) -> DataFrame:
    """The members to compare with all others of their bucket.

    Of buckets of more than ``small`` it is the one with most company, the ``hub``. Of
    others, and of all for None, it is every one that is not of the largest component.
    """
    sizes = members.groupBy("bucket", "comp").agg(F.count("*").alias("of_comp"))
    largest = sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("of_comp", "comp")).alias("largest"))
    rest = members.join(largest, "bucket").where("comp != largest").drop("largest")
    rest = rest.withColumn("hub", F.lit(False))
    if small is None:
        return written(rest, "centres", SLIM)
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    large = members.where(F.col("size") > small)
    rank = F.max(F.struct("company", (-F.col("node")).alias("rank"))).alias("m")
    hubs = large.join(company, "node").groupBy("bucket").agg(rank).select("bucket", (-F.col("m.rank")).alias("node"))
    hubs = large.join(hubs, ["bucket", "node"], "left_semi").withColumn("hub", F.lit(True))
    return written(rest.where(F.col("size") <= small).unionByName(hubs), "centres", SLIM)


def _linked(members: DataFrame, texts: Texts, width: int, percent: int) -> DataFrame:
    """(node, component) of all classes that are similar to another one of a bucket."""
    hubs = written(_hubs(members), "hubs", SLIM).withColumns({"d": F.col("n"), "left": F.col("most"), "hub": F.lit(True)})
    members = members.withColumns({"d": F.col("n"), "left": F.col("most"), "comp": F.col("node")})
    pairs = written(_candidates(members, hubs, percent), "pairs", SLIM)
    sets = _sets_of(pairs.select("a").unionAll(pairs.select("b")), texts, width)
    comps = joined_components(None, _confirmed(pairs, sets, percent))
    nodes = _open(members, hubs, comps).select("node", "comp").distinct()
    if nodes.isEmpty():
        return comps
    sets = _sets_of(nodes, texts, width)
    members = _rarest_shared(sets, nodes, percent)
    members = _open(members, members.limit(0), comps)
    rounds = 0
    while not members.isEmpty():
        centres = _centres(members, SMALL if rounds < PARTINGS else None)
        pairs = written(_candidates(members, centres, percent), "pairs", SLIM)
        if not pairs.isEmpty():
            comps = joined_components(comps, _confirmed(pairs, sets, percent))
        members = _open(members, centres, comps)
        if rounds < PARTINGS and not members.isEmpty():
            members = _parted(members, centres.where("hub"), comps, sets, percent)
            members = _open(members, members.limit(0), comps)
        rounds += 1
    return comps


def near_duplicates(
    df: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str | None = None,
) -> DataFrame:
    """A row for each document: size of its shingle set, its component and whether it is kept.

    A set holds the distinct shingles of ``width`` words, A-Z in lower case, of
    the whole text; with fewer words the whole sequence is its one shingle.
    Documents with ``100 * common >= percent * union`` are linked; a component
    is named by its least id, and the document of that id is kept. Texts that
    are null or without words have an empty set, are linked with nothing and
    kept. Rows with a null id are linked with nothing and kept, with a null
    component. Rows that repeat an id are judged by their own text each. Other
    columns are ignored; an empty table gives no rows.

    ``part_col``, a number such as a hash of the text, tells rows of one id
    apart: those of other parts are documents of their own, of a component the
    least part of its least id is kept, and the result has a column ``part``.
    """
    short_batches(df.sparkSession)
    part = F.lit(0) if part_col is None else F.col(part_col)
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), part.cast("long").alias("part")
    )
    bands = bands_for(percent, ROWS_PER_BAND)
    sketched = written(docs.mapInArrow(_sketch(width, bands, ROWS_PER_BAND), SKETCH), "sketches")
    filled = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["n_shingles", "set_a", "set_b"]
    own = F.struct("doc_id", "part")
    classes = filled.groupBy(*key).agg(F.min(own).alias("first"), F.min_by("buckets", own).alias("buckets"))
    node = F.col("doc_id") if part_col is None else F.monotonically_increasing_id()
    classes = written(classes.select(*key, "first.*", "buckets").withColumn("node", node), "classes", SLIM)
    if part_col is None:
        texts = _texts_by_id(docs)
    else:
        repeated = filled.groupBy("doc_id", "part").count().where("count > 1")
        texts = _texts_by_class(docs, classes, not repeated.isEmpty())
    members = _members(
        classes.select("node", F.col("n_shingles").alias("n"), F.col("n_shingles").alias("most"), "buckets")
    )
    linked = classes.drop("buckets").join(_linked(members, texts, width, percent), "node")
    least = linked.groupBy("component").agg(F.min(own).alias("least"))
    names = linked.join(least, "component").select("node", "least")
    name = F.coalesce("least", own)
    names = classes.drop("buckets").join(names, "node", "left").select(*key, name.alias("name"))
    name = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("name")), own)
    first = (F.col("name.doc_id") == F.col("doc_id")) & (F.col("name.part") == F.col("part"))
    return (
        sketched.drop("buckets")
        .join(names, key, "left")
        .withColumn("name", name)
        .select(
            "doc_id",
            *([] if part_col is None else ["part"]),
            "n_shingles",
            F.col("name.doc_id").alias("component_id"),
            F.coalesce(first, F.lit(True)).alias("kept"),
        )
    )


ship(__name__)
