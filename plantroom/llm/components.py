"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.llm.shared import stored


def _least(links: DataFrame) -> DataFrame:
    """Each vertex with the least of its neighbours and itself."""
    return links.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """`v`, `component` for every vertex of the links (a, b); the component is its least vertex.

    In turns, every vertex links its larger neighbours to the least of all (large star), and its smaller ones, itself
    included, likewise (small star), until nothing changes: every vertex then points at the least of its component.
    The number of rounds grows with the logarithm of the longest path. Links are kept in the shared folder, never
    collected; a vertex of many links costs a row per task in the minimum and is split in the join.
    """
    links = links.where("a is not null and b is not null and a <> b")
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        both = _both_ways(edges)
        large = both.where("b > a").join(_least(both), "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        low = _least(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        edges = stored(small.where("a <> b").distinct(), name)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(30,0)")).alias("h")).first()
        if now == state or not now["n"]:
            break
        state = now
    return edges.select(F.col("a").alias("v"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("b").alias("component")).distinct()
    )
