"""Connected components of a link table by alternating large-star and small-star rounds.

Each round joins the links with the smallest neighbour of a node (one grouped minimum, combined map-side) and
rewires them towards it.  A node with very many links costs its links' rows only: the minimum is combined before
the shuffle and AQE may split the join.  Rounds grow with the logarithm of the longest chain.  Every round
writes its links to the shared scratch folder, so lineage stays short and a lost executor costs one round.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

MAX_ROUNDS = 200


def connected_components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b; longs without nulls): component = smallest reachable node."""
    now = scratch.write(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), f"{name}-0")
    before = _print(now)
    for r in range(1, MAX_ROUNDS):
        nxt = scratch.write(_small_star(_large_star(now)), f"{name}-{r}")
        after = _print(nxt)
        scratch.drop(f"{name}-{r - 1}")
        now = nxt
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not settle")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))


def _print(links: DataFrame) -> tuple:
    """Count and order-free hash sum of the links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Connect every strictly larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    # links are stored (larger, smaller): the larger neighbours of node n are the rows with b = n
    return (links.select(F.col("b").alias("node"), F.col("a").alias("v")).join(least.withColumnRenamed("a", "node"), "node")
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of a node, and the node, to its smallest neighbour."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
