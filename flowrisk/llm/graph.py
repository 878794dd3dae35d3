"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowrisk.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a"), F.least("a", "_m").alias("_m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    rest = down.join(least, "a").filter(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return rest.unionByName(least.withColumnRenamed("_m", "b"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node with an edge but the roots.

    Rounds grow with the logarithm of the longest path; each is written to the shared
    folder, so a lost executor costs one round. Links of a node to itself and null ends
    count for nothing.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)).distinct(), "components")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).collect()[0])
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
