"""Connected components of a graph of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelake.session import stored


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) -> (node, component) for every linked node; the component is its smallest node.

    Large-star hooks a node's larger neighbours to its smallest neighbour,
    small-star does so with the smaller ones. Every round is stored, and the
    number of rounds grows with the logarithm of the longest path. A node with
    any number of links is only ever aggregated or joined.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .where("u <> v").distinct(), name)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = stored(large, name)
        lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = (edges.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(lowest.select("u", F.col("m").alias("v")))
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        edges = stored(small, name)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
