"""Connected groups of nodes that belong to some key, such as the boxes of a page."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.sources.files import stored


def connected_groups(pairs: DataFrame, key: str, a: str, b: str, local_pairs: int = 100_000) -> DataFrame:
    """(key, node, group): each node of a pair with the smallest one that it reaches within its key.

    Keys with local_pairs pairs at most are settled by one task each; larger ones
    by rounds of joins over all tasks. Both ways give the same groups.
    """
    edges = stored(pairs.select(F.col(key).alias("key"), F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v"))
    large = edges.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > local_pairs).select("key")
    found = _local(edges.join(large, "key", "left_anti") if (some := bool(large.head(1))) else edges)
    if some:
        found = found.unionByName(_rounds(edges.join(large, "key", "left_semi")))
    return found.select(F.col("key").alias(key), "node", "group")


def _local(edges: DataFrame) -> DataFrame:
    """Groups of keys with few pairs, by joining trees."""
    key, node = (edges.schema[c].dataType.simpleString() for c in ("key", "u"))
    gathered = edges.groupBy("key").agg(F.collect_list("u").alias("u"), F.collect_list("v").alias("v"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, nodes, groups = [], [], []
            for k, us, vs in zip(batch["key"], batch["u"], batch["v"]):
                parent: dict = {}

                def root(x):
                    parent.setdefault(x, x)
                    while parent[x] != x:
                        parent[x] = x = parent[parent[x]]
                    return x

                for u, v in zip(us, vs):
                    low, high = sorted((root(u), root(v)))
                    parent[high] = low
                own = list(parent)
                keys += [k] * len(own)
                nodes += own
                groups += [root(x) for x in own]
            yield pd.DataFrame({"key": keys, "node": nodes, "group": groups})

    return gathered.mapInPandas(run, f"key {key}, node {node}, group {node}")


def _rounds(edges: DataFrame) -> DataFrame:
    """Groups by rounds: every node hands its larger neighbours to the smallest one it knows, then its smaller ones.

    Each round is written to the shared folder; a count and a checksum tell whether it changed anything.
    """
    now, before = stored(edges.distinct()), None
    while True:
        both = now.unionByName(now.select("key", F.col("v").alias("u"), F.col("u").alias("v")))
        known = both.groupBy("key", "u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        up = both.join(known, ["key", "u"]).filter("v > u").select("key", F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()
        low = up.groupBy("key", "u").agg(F.min("v").alias("low"))
        down = up.join(low, ["key", "u"])
        now = stored(down.select("key", "u", F.col("low").alias("v")).unionByName(down.filter("v <> low").select("key", F.col("v").alias("u"), F.col("low").alias("v"))).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("key", "u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select("key", F.col("u").alias("node"), F.col("v").alias("group")).unionByName(now.select("key", F.col("v").alias("node"), F.col("v").alias("group")).distinct())
        before = state
