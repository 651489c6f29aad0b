"""Connected components of an undirected graph, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.runtime import settle


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Large-star and small-star rounds: each node links its neighbours to the smallest of them.  Rounds grow with
    the logarithm of the longest path; a hot node's neighbours pass through aggregations that combine before the
    shuffle and joins that adaptive execution can split.  Each round is written to the checkpoint folder.
    """
    # Links point from the larger to the smaller node.
    edges = settle(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    nodes = links.select(F.explode(F.array(a, b)).alias("node")).distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40)), F.sum(F.xxhash64("v", "u") % (1 << 40))).first())

    before = mark(edges)
    while before[0]:
        # Large star: of a node's neighbours, the larger ones link to the smallest of node and neighbours.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours link to the smallest of those.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = settle(small)
        now = mark(edges)
        if now == before:
            break
        before = now
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
