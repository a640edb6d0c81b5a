"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the least node reachable.

    Alternates large-star and small-star steps, each a grouped minimum and a
    join, until the edges stop changing; the number of rounds grows with the
    logarithm of the nodes. Every round is a written table, so a lost executor
    costs a part of one round. So are the minima: the join then reads both of
    its sides from a shuffle, and Spark can split a hub's edges.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    star = stored(pairs.distinct())
    seen = _digest(star)
    while seen[0]:
        star = stored(_small_star(_large_star(star)))
        now = _digest(star)
        if now == seen:
            break
        seen = now
    heads = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads)


def _digest(star: DataFrame) -> tuple[int, int]:
    """Rows and an order-free checksum; equal ones mean that nothing moved."""
    row = star.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("checksum")
    ).first()
    return row.n, row.checksum


def _large_star(star: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the node's least neighbour."""
    both = star.union(star.select("v", "u").toDF("u", "v"))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )


def _small_star(star: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the least of them."""
    least = stored(star.groupBy("u").agg(F.min("v").alias("m")))
    moved = star.join(least, "u").where("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
