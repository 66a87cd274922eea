"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.sources.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return tied.union(least.select("a", F.col("low").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """node and root, the least node it reaches, for every node that is not a root itself.

    ``edges`` has columns a and b. Nodes with very many edges are only ever reduced by a partial minimum and a join. Each
    round is written, so a lost executor costs one round at most. The rounds end when the stars stay as they are.
    """
    current = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = _state(current)
    while state[0]:
        stars = _small_star(_large_star(current)).where("a <> b").distinct()
        current = written(stars, "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
