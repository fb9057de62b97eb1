"""Connected components of a links table by alternating large-star and small-star rounds, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import forget, saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every id in ``links`` the smallest id it is connected to, itself included.

    Each round keeps a set of edges (u, v), u > v, with the same components as before and shorter ways to each
    smallest id; it ends when a round changes nothing (a number of rounds that grows with the logarithm of the
    longest way). Minima are combined before the shuffle; edges are written to the shared folder every round. Null ids and loops count for nothing.
    """
    spark = links.sparkSession
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    edges, path = saved(spark, links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state, old = _state(edges), None
    while state != old:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        before = path
        edges, path = saved(spark, small, "edges")
        forget(spark, before)
        old, state = state, _state(edges)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
