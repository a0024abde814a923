"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch


def components(pairs: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``pairs`` (a, b): the smallest node that can be reached.

    Alternates two contractions that keep components as they are: each node hands its larger
    neighbours to the smallest one it knows, then its smaller ones. Pairs shrink to stars around each
    component's smallest node in logarithmically many rounds. All groupings are minima, taken before
    the shuffle; a node with very many neighbours stands on the side of the join that can be split.
    Every round is stored, so a lost executor costs that round at most.
    """
    edges = pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, last, step = scratch.keep(edges, f"{name}-0"), None, 0
    while True:
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("bigint")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last, step = state, step + 1
        large = scratch.keep(_large_star(edges), f"{name}-{step}-large")
        after = scratch.keep(_small_star(large), f"{name}-{step}")
        scratch.drop(f"{name}-{step}-large")
        if step > 1:
            scratch.drop(f"{name}-{step - 1}")
        edges = after
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
