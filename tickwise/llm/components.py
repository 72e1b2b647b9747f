"""Connected components of an edge table by alternating large-star and small-star steps.

Each step links a node's neighbours to the smallest of them (one aggregate and one join over the
edges), so no task holds a component and the number of rounds grows with the logarithm of the
graph's diameter. Every round is written to the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.joins import lookup
from tickwise.session import materialize, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return lookup(both, least, ["u"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = lookup(down, least, ["u"]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (u, v) of longs."""
    spark = edges.sparkSession
    edges = materialize(spark, edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        before, edges = edges, materialize(spark, _small_star(_large_star(edges)), "edges")
        release(spark, before)
        last, state = state, _state(edges)
        if state == last:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
