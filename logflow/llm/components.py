"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.scratch import materialize


def are_stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges (a, b)``, without repeats, has one edge out or only edges in."""
    role = lambda of, out: edges.select(F.col(of).alias("node"), F.lit(out).alias("out"))
    nodes = role("a", 1).unionByName(role("b", 0)).groupBy("node")
    nodes = nodes.agg(F.sum("out").alias("n"), F.min("out").alias("least"))
    return not nodes.agg(F.max((F.col("n") > 1) | ((F.col("n") > 0) & (F.col("least") == 0)))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``: the smallest node that links reach from it.

    Alternating stars: every node links its larger neighbours to its smallest one, then its smaller neighbours
    and itself; links become stars within a number of rounds that grows with the logarithm of the longest
    chain.  Each round is a written table, and only whether all links are stars comes to the driver.
    """
    # Edges point from the larger node to the smaller one.
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = materialize(edges, "edges")
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large.where("a <> b"), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(low.withColumnRenamed("low", "b"))
        edges = materialize(small.distinct(), "edges")
    centers = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centers)
