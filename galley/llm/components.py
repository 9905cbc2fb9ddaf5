"""Connected components of a distributed graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.session import cut_lineage


def _settled(edges: DataFrame) -> bool:
    """Every node has one parent or is one, but not both."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).where("c > 1 OR c > 0 AND p > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """links: (a, b), long. Returns (id, label) of every linked id: the smallest id of its component.

    Both steps take a minimum over neighbours by a map-side-combined aggregate and join it back,
    so a hub is never gathered in one task. Each round is checkpointed once; rounds grow with the
    logarithm of the number of nodes.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = cut_lineage(edges)
    while not _settled(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).union(roots)
