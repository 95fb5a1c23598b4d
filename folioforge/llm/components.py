"""Connected components of a graph of long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import discard, stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of an edge with the smallest node that it reaches.

    Each round links every node's larger neighbours to the smallest one, then
    every node's smaller neighbours; chains shrink geometrically. Rounds are
    written to the shared folder, and only a count and a checksum reach the
    driver.
    """
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        large = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = large.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = large.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = linked.groupBy("u").agg(F.min("v").alias("m"))
        small = linked.join(least, "u")
        last, now = now, stage(
            small.select("u", F.col("m").alias("v")).unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "edges"
        )
        discard(last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state
