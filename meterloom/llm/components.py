"""Connected components of an edge table, by alternating large-star and small-star steps on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of an edge between different nodes.

    Each step is an aggregate with map-side combine and a join back, which adaptive execution splits for hot nodes; only
    whether a round left something to do reaches the driver.  Edges with a null end and loops are left out.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = store.stored(edges.filter(F.col(a) != F.col(b)).select(high, low).distinct(), "edges")
    while not _done(now):
        before, now = now, store.stored(_small_star(_large_star(now)), "edges")
        store.release(before)
    ends = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(ends)


def _done(e: DataFrame) -> bool:
    """Whether every node is either the root of its edges or has one edge, to its root."""
    chained = e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")
    forked = e.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
    return chained.unionByName(forked).isEmpty()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
