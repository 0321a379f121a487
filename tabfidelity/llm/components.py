"""Connected components by alternating large-star and small-star, on edges in tables.

Each step is a sum by node, written, and a join with the table of it, so a node with a third of all edges is one row after the sum and a
join key with a plain exchange on either side, which the planner splits. Every round is written to the shared folder, which cuts the lineage. Rounds stop when the
edges no longer change; they are then stars around the least node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _mark(edges: DataFrame) -> tuple[int, object]:
    """Count and sum of hashes: equal edges have equal marks whatever their order."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = scratch.table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """edges have u > v."""
    least = scratch.table(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str, max_rounds: int = 60) -> DataFrame:
    """node and root, the least node of its component, for every node of edges (u, v) but the roots themselves."""
    now = scratch.table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), f"{name}-0")
    mark = _mark(now)
    for i in range(1, max_rounds + 1):
        if not mark[0]:
            break
        large = scratch.table(_large_star(now, scratch, f"{name}-{i}-least-large"), f"{name}-{i}-large")
        now = scratch.table(_small_star(large, scratch, f"{name}-{i}-least-small"), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}", f"{name}-{i}-large", f"{name}-{i}-least-large", f"{name}-{i}-least-small")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
