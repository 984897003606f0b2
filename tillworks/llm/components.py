"""Connected components of a link table by alternating large and small stars, every round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least node in reach of one step."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a and b > m").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b")).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root): each linked node with the least node of its component; edges (a, b) in any direction.

    A hub's links are aggregated before they are shuffled and the joins can be split, so no component and no
    neighbourhood is gathered in one place.
    """
    e = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e, before = stored(e, "links"), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        e = stored(_small_star(_large_star(e)), "links")
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).union(e.select(F.col("a"), F.col("a")).distinct())
