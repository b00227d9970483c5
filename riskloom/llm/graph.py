"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round groups edges by one end with map-side aggregation and writes the new edge table to the shared folder, so
lineage stays short and a lost executor costs one round.  Nothing is collected but one count per round.  A hub that
holds many edges is met through ``min`` aggregation and a join on its single row, not through a gathered list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the least node of its component.  Self-loops are allowed."""
    e = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: each larger neighbour of a node hangs on the least neighbour (or the node itself)
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        low = materialise(low, "least")
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = materialise(large.distinct(), "large-star")
        # small star: each smaller neighbour, and the node, hang on the least one
        low = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = materialise(small, "small-star")
        # stars are stable when no node is both a child and a centre
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
