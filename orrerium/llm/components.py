"""Connected components of an edge list by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; what a node knows is one smaller neighbour at a time, so that no component
is ever gathered in one place. A node with a large share of the edges, such as the centre of a star, gets its minimum sent
to its edges instead. Each step is checkpointed, so that a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, spread_join


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    moved = spread_join(both.filter("b > a"), least, "a", 2 * total)
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Edges point from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    moved = spread_join(edges, least, "a", total)
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root` (its component's least node) for every node with an edge. edges: long columns a and b."""
    edges = checkpoint(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = None
    while True:
        # Equal sums of counts and hashes mean that the last round changed nothing.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        edges = checkpoint(_large_star(edges, now[0]))
        edges = checkpoint(_small_star(edges, now[0]))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
