"""Bounded breadth-first reachability over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.session import broadcast_if_small, cut_lineage


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int = V.MAX_LINK_DEPTH) -> DataFrame:
    """Every node within ``max_depth`` steps of a seed, with its least depth.

    ``edges`` has columns src and dst, ``seeds`` has node.  Each round joins the new
    nodes (broadcast while their number is small) to the edges, combines duplicates on the map side, and drops nodes already
    seen.  Rounds are checkpointed in the shared folder, so the plan stays short and a
    lost executor costs no earlier round.  A hub with many links is a skewed join
    partition, which adaptive execution splits.
    """
    edges = cut_lineage(edges.select("src", "dst").distinct())
    frontier = cut_lineage(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    visited = frontier
    for depth in range(1, max_depth + 1):
        reached = (
            edges.join(broadcast_if_small(frontier.select(F.col("node").alias("src"))), "src", "left_semi")
            .select(F.col("dst").alias("node")).distinct()
        )
        frontier = cut_lineage(reached.join(visited, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited
