"""Connected components of a graph given as pairs, by stars that shrink towards the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.sources.scratch import stage


def large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; ``a > b`` in all edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``root``: the smallest node reachable from ``a``, for all nodes but the roots.

    ``edges`` has columns a and b; loops and repeated or turned edges do no harm, no
    edges give no rows. Each round is written to the shared folder, so lineage stays
    short; the rounds end when one changes nothing.
    """
    turned = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = stage(turned.distinct(), "edges"), None
    while True:
        sums = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if before == sums:
            return current.select("a", F.col("b").alias("root"))
        before = sums
        current = stage(small_star(large_star(current)), "stars")
