"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node it reaches) of links ``u``, ``v`` of one orderable type.

    Large-star and small-star rounds until nothing changes. No node's neighbours are
    gathered: least values are aggregated and joined back, so a star of any size is
    spread. Every round is written to the shared folder. Nodes without a link to another
    are left out; links to oneself and links with a null are passed over; no links give
    an empty table.
    """
    edges = stored(links.where("u <> v").select("u", "v").distinct(), "links")
    mark = None
    while True:
        # Equal counts and equal sums of hashes of two rounds mean equal tables.
        seen = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == mark or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = seen
        edges = stored(_small_star(_large_star(edges)), "links")
