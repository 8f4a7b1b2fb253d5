"""Connected components of a link table, by alternating large and small stars.

Every round groups by node with partial aggregation and joins the minimum back, so a hub with many links
is split like any skewed join key. Minima and rounds are written to the shared folder; nothing but two numbers a
round reaches the driver. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kept import keep


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with the least of u and all its v as ``m``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Written, so that the join reads both sides from shuffles of its own and Spark can split a hub.
    return edges.join(keep(least, "least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down)
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(linked.select("u", F.col("m").alias("v")))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    # decimal: a sum of 64-bit hashes passes 64 bits
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v; bigint, no nulls) to (node, root): every linked node and the least node it reaches."""
    edges = keep(links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _mark(edges)
    while True:
        edges = keep(_small_star(_large_star(edges)), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
