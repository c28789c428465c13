"""Connected components of a link table, as Spark joins and aggregations.

Alternates the two star operations of Kiveris et al., "Connected Components in MapReduce and
Beyond" (2014). Every step is written to the shared folder, so lineage stays short and a lost
executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.sources.stores import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect neighbours of every node to the least of them and the node itself. ``edges`` are (u, v), u > v."""
    near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select("u", "v")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if large:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one least node and none hangs on a node that hangs itself."""
    ends = edges.select(F.col("u").alias("node"), "v").union(edges.select(F.col("v").alias("node"), F.lit(None).alias("v")))
    per_node = ends.groupBy("node").agg(F.count("v").alias("up"), F.count(F.lit(1)).alias("all"))
    return per_node.where("up > 1 or (up = 1 and all > 1)").isEmpty()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node with a link; the component is its least node. Nodes are
    non-null and of one ordered type."""
    edges = stage(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                  .where(F.col("u") != F.col("v")).distinct(), "links")
    while not _settled(edges):
        edges = stage(_star(_star(edges, large=True), large=False), "links")
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
