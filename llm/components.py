"""Connected components by alternating large and small stars, one shuffle table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import Scratch


def _least(edges: DataFrame) -> DataFrame:
    """Edges u, v with the smallest neighbour of u, itself included; counted in tasks before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root for every end of an edge (columns a, b): the smallest node that links reach."""
    now = scratch.table(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _least(large)
        small = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(near.select("u", F.col("m").alias("v")))
        now = scratch.table(small.distinct())
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
