"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u moves to u's least neighbour (or u)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its neighbours below it move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root (the least node of its component) for every node of
    ``edges`` (u, v longs). No node's edges meet in one task: least neighbours
    are partial aggregates, and the joins leave hot nodes to be split."""
    ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = stored(edges.filter(F.col("u") != F.col("v")).select(*ends).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        now = stored(_small_star(_large_star(now).select(*ends)), "edges")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            roots = now.select(F.col("v").alias("u")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .unionByName(roots.select(F.col("u").alias("node"), F.col("u").alias("root")))
        mark = seen
    raise RuntimeError("components did not settle")
