"""Connected components by alternating large-star and small-star steps.

Each step is two aggregations and two joins on the edge list, so a node with
very many links is spread by the joins' skew handling; nothing is collected.
Every round is written to the shared checkpoint folder and read back; rounds end
when the edges are stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import staged


def _settled(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour at most, and none if it is one itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        "up > 1 or up = 1 and down = 1").isEmpty()


def connected_components(spark: SparkSession, links: DataFrame, name: str) -> DataFrame:
    """``links(a, b)``, undirected; returns (node, component) for every node that
    has a link to another, component being the smallest node it reaches.
    Repeated links, self links and links with a null are harmless."""
    edges = staged(spark, links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), f"{name}-links")
    while not _settled(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = staged(spark, small, f"{name}-round")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
