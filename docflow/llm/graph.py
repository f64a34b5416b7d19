"""Connected components of an edge table by large-star and small-star steps.

Both steps hang the neighbours of a node on the least of them, one on the
larger, one on the smaller neighbours, until only stars are left (Kiveris et
al., "Connected Components in MapReduce and Beyond", 2014). Each step is an
aggregation with map-side combine and a join, so a node with very many edges is
split like any skewed key; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").where("b != m").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    hung = edges.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return hung.unionAll(least.select(F.col("m").alias("a"), "b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node but the centres hangs on exactly one centre."""
    torn = edges.groupBy("b").count().where("count > 1").select("b")
    centres = edges.select(F.col("a").alias("b"))
    return torn.unionAll(edges.select("b").join(centres, "b", "left_semi")).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is the least node in it.

    ``edges`` has ids ``a`` and ``b`` in any direction, repeated or not; loops
    and edges with a null end are left out. No edges give no rows.
    """
    clean = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = written(clean.distinct(), "edges", 1)
    while not _are_stars(now):
        now = written(_small_star(_large_star(now)), "edges", 1)
    roots = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(roots)


def joined_components(known: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Components of ``known`` ones and further edges: only what the edges touch is worked on anew."""
    if known is None:
        return written(components(edges), "components", 1)
    ends = edges
    for end in ("a", "b"):
        name = known.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        ends = ends.join(name, end, "left")
    lifted = ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = components(lifted)
    by_name = moved.select(F.col("node").alias("component"), F.col("component").alias("new"))
    renamed = known.join(by_name, "component", "left")
    renamed = renamed.select("node", F.coalesce("new", "component").alias("component"))
    return written(renamed.unionAll(moved.join(known, "node", "left_anti")), "components", 1)
