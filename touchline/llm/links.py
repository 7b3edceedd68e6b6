"""Connected components of links, by alternating large-star and small-star rounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import cut_lineage


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One round on edges (u, v): every node's neighbours above it (or it and those below) go to its smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if large else both.where("v < u")
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of a link that is not itself the smallest of its component; root is that smallest node.

    Rounds end when an exact checksum of the edges no longer changes; the number of rounds grows
    with the logarithm of the longest path. Each round is checkpointed. No adjacency list is
    gathered: hot nodes only meet in pre-aggregated minima and in joins that split skewed keys.
    Links from a node to itself, repeated links and missing ends are ignored.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    edges = cut_lineage(edges.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
        edges = cut_lineage(_starred(_starred(edges, True), False))
