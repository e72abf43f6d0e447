"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settled


def connected(links: DataFrame) -> DataFrame:
    """Nodes of links (a, b) that are not the smallest of their component, with it: (node, root).

    Each round hangs every larger neighbour of a node under the node's smallest neighbour (large star), then every
    smaller neighbour too (small star); components end as stars around their smallest node, in a number of rounds that
    grows with the logarithm of their size. Tables hold one row per link; joins are between settled tables, so AQE
    can split a node with many links. Rounds are settled in the shared folder.
    """
    edges = settled(_turned(links.select(F.col("a").alias("x"), F.col("b").alias("y"))), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("big", "small")), F.sum(F.col("small") % 1_000_003)).first()
        if state == seen:
            return edges.select(F.col("big").alias("node"), F.col("small").alias("root"))
        seen = state
        edges = _small_star(_large_star(edges))


def _turned(pairs: DataFrame) -> DataFrame:
    return (
        pairs.filter("x <> y").select(F.greatest("x", "y").alias("big"), F.least("x", "y").alias("small")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    # A node's smallest neighbour is below itself only where the node is the larger end of some link.
    least = settled(edges.groupBy("big").agg(F.min("small").alias("least")), "least").withColumnRenamed("big", "node")
    moved = edges.join(least, edges["small"] == least["node"], "left")
    return settled(
        moved.select(F.col("big").alias("x"), F.coalesce("least", "small").alias("y"))
        .unionByName(least.select(F.col("node").alias("x"), F.col("least").alias("y")))
        .transform(_turned), "large")


def _small_star(edges: DataFrame) -> DataFrame:
    least = settled(edges.groupBy("big").agg(F.min("small").alias("least")), "least")
    moved = edges.join(least, "big").select(F.col("small").alias("x"), F.col("least").alias("y"))
    own = least.select(F.col("big").alias("x"), F.col("least").alias("y"))
    return settled(moved.unionByName(own).transform(_turned), "small")
