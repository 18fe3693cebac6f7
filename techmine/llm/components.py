"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low, "u").where("v > u")
                .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is the
    smallest node reachable, itself included.

    Each round shrinks paths by a constant factor and ends when the edges are
    stars around the smallest nodes.  The rounds are written to the shared
    folder.  Hubs meet pre-aggregated minima; the joins shuffle both sides, so
    AQE splits a hub's edges.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u <> v").distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        edges = stored(_small_star(_large_star(edges).distinct()), "edges")
    tops = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
                 .union(tops.select("node", F.col("node").alias("component"))))
