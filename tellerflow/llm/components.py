"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerflow.operators.sinks import durable


def _toward_smallest(near: DataFrame) -> DataFrame:
    """(u, v) pairs with the smallest of u and its v joined on, written as ``low``."""
    low = near.groupBy("u").agg(F.min("v").alias("low"))
    return near.join(low.select("u", F.least("u", "low").alias("low")), "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (u, v), label being the component's smallest node.

    Large star: every node hands its larger neighbours to its smallest one.
    Small star: every node hands its smaller neighbours and itself to its
    smallest one. Both keep components; when nothing changes, every node points
    at its component's smallest. Only two sums per round reach the driver; a node
    with many neighbours is a skewed join key, which Spark splits.
    """
    edges = durable(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        small = _toward_smallest(large)
        small = small.select("v", "low").union(small.select("u", "low")).toDF("u", "v").where("u <> v").distinct()
        edges = durable(small, "edges")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())
