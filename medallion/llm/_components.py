"""Connected components of an edge table by large-star and small-star steps.

Every step is a grouped minimum and an equi-join; nothing is collected but a
row count and checksum per round. Components that are nearly stars take two or
three rounds, a chain of n vertices about log n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm._blocks import written


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (a, b), root the least vertex reachable."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    before = _sum(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        after = _sum(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return roots.unionByName(e.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
