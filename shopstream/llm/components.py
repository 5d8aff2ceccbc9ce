"""Connected components of an edge table, by alternating star contractions.

Each round is two joins of the edges with per-node minima (partial
aggregates), written to the shared folder, so no lineage grows and a lost
executor costs one round's tasks. Hub nodes make large join partitions, which
adaptive execution splits. Nothing but one row count and checksum per round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minima(both).select("u", F.least("m", "u").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the smallest."""
    low = _minima(edges)
    moved = edges.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v), u > v: root is the
    smallest node reachable; roots themselves are not listed."""
    stars, seen = materialise(edges.where("u > v").distinct(), "links"), None
    while True:
        n, mark = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, mark) == seen or not n:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = (n, mark)
        stars = materialise(_small_star(_large_star(stars)), "links")
