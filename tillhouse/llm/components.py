"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v.  The least neighbour of a node is found by a partial aggregation."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("m", "u").alias("m"))
        moved = both.where("v > u").join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least.withColumnRenamed("u", "node"), F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): the root is the least node that can be reached.

    Edges may repeat and may be loops.  Every round is written to the shared folder, which cuts its lineage.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, f"{name}-edges")
    sign = None
    while True:
        edges = materialise(_star(_star(edges, True), False), f"{name}-round")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == sign:
            break
        sign = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
