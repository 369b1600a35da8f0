"""Connected components of a graph whose edges are rows: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialize


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``a`` and ``b`` (longs) to ``node, root``: the smallest node of each component.

    A large star ties every node's larger neighbours to its smallest neighbour, a small star
    its smaller ones; the number of rounds grows with the logarithm of the longest chain.
    Smallest neighbours are combined before the shuffle, and written before they are joined,
    so that a node with a third of all edges is a join that adaptive execution can split.
    Nodes without an edge to another node are left out; nulls take no part.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = materialize(ordered.distinct())
    before, now = None, _digest(stars)
    while now != before and now[0]:
        both = stars.union(stars.select("b", "a"))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")))
        larger = stars.select(F.col("b").alias("a"), F.col("a").alias("v"))
        large = materialize(larger.join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = materialize(small.union(least.withColumnRenamed("m", "b")).distinct())
        before, now = now, _digest(stars)
    roots = stars.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
