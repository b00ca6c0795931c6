"""Connected components of a table of links, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm._common import discard, materialise


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    near = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return near.where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(low, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``, component the smallest node reachable, for every node of a link ``(u, v)`` of two longs.

    Rounds go on until one changes nothing; each makes components' smallest nodes meet, so there are about as many as the
    logarithm of the longest path. Each round is a written table; a node with very many links is aggregated in the map tasks, and its links are joined to one
    row. Self links and nulls are left out; without links the result is empty.
    """
    now = materialise(edges.where("u <> v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct(), "links")
    before = None
    while True:
        new = materialise(_small(_large(now)), "links")
        discard(now)
        now = new
        # the links form stars when a round changes nothing: equal count and equal sums of hashes
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.hash("v", "u").cast("long"))).first())
        if state == before:
            break
        before = state
    stars = now.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
