"""Connected components of an edge table: alternating large-star and small-star rounds.

Every round is two grouped minima and two joins back (a hot node is split by the
skew join, no neighbourhood is ever collected), written to the shared folder.
The rounds end when the edge table no longer changes; each component is then a
star around its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.work import written


def _fingerprint(edges: DataFrame):
    return edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()


def _large_star(edges: DataFrame, folder: str, name: str) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # written, so that the join has two plain exchanges and Spark can split a hot node
    least = written(least.select("u", F.least("u", "m").alias("m")), folder, name)
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame, folder: str, name: str) -> DataFrame:
    # every edge points from the larger to the smaller node
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), folder, name)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def components(edges: DataFrame, folder: str, name: str = "cc") -> DataFrame:
    """``node, component`` of every node of ``edges`` (columns ``a``, ``b``); component: smallest node.

    Loops and repeated edges are harmless. Nodes without an edge to another node
    are not returned. An empty edge table gives an empty result.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    edges = written(edges, folder, f"{name}_0")
    seen, step = _fingerprint(edges), 0
    while seen["n"]:
        step += 1
        large = written(_large_star(edges, folder, f"{name}_{step}_a"), folder, f"{name}_{step}_large")
        edges = written(_small_star(large, folder, f"{name}_{step}_b"), folder, f"{name}_{step}")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
