"""Connected components by alternating large-star and small-star.

Each half step replaces the edges of every node by edges to the smallest node
it knows; the steps end when the edges are stars.  Smallest neighbours are
found by partial aggregation and attached with ``attach``, so a hub with any
share of all edges is neither one task's work nor one group.  Edges are
written to the shared folder after each half step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.llm.common import attach, written


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "cc-min")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    known = attach(both, _least_neighbour(both), ["u"], "n")
    return known.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    least = _least_neighbour(edges)
    known = attach(edges, least, ["u"], "n").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return known.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (u, v)."""
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    mark = _mark(now)
    while mark[0]:
        step = written(small_star(written(large_star(now), "cc-large")), "cc-small")
        before, mark, now = mark, _mark(step), step
        if mark == before:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
