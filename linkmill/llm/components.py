"""Connected components of a link table, by alternating star contraction on Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import Staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node, component (smallest node reachable) for all nodes with a link.

    Each round joins every node's neighbours to the smallest of them: first the
    larger neighbours (large star), then the smaller ones and the node (small star).
    Only sums come to the driver; every round is written to the shared folder. The
    minimum of a node is aggregated before the shuffle, so a node with very many links
    is no larger task; joins have one row per node on one side and can be split.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    kept, state = Staged(edges, "links"), None
    while True:
        e = kept.df
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        following = Staged(small.where("u <> v").distinct(), "links")
        kept.drop()
        kept = following
        new = kept.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    stars = kept.df
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def spanning_forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest: as connected as all links, at most one per vector."""
    root: dict[int, int] = {}

    def find(x):
        while (y := root.setdefault(x, x)) != x:
            root[x] = root[y]
            x = root[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    return kept
