"""Connected components of an edge table, by alternating star contractions on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.session import scratch_path, settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, root)`` for every vertex of ``edges (a, b)`` but the roots themselves.

    The root is the smallest vertex of its component. Each round is written to shared storage and counted; the
    rounds end when the edges no longer change, after a number of them that grows with the logarithm of the
    longest chain. A hub's edges are split by the planner's skew join, as only its one smallest neighbour stands
    against them.
    """
    spark = edges.sparkSession
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    ordered, before = settle(ordered, scratch_path(spark, "edges")), None
    while True:
        mark = ordered.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before or not mark[0]:
            return ordered.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        before = tuple(mark)
        ordered = settle(_small_star(_large_star(ordered).distinct()).distinct(), scratch_path(spark, "edges"))
