"""Breadth-first traversal of a link table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawmill.session import stage


def reachable(edges: DataFrame, start: DataFrame, max_depth: int, leaf: Column | None = None, max_discovered: int | None = None) -> DataFrame:
    """(node, depth) of every node that links reach from ``start`` (node), at its least depth.

    ``edges`` has src and dst; nodes for which ``leaf`` holds (documents) are kept but not
    followed. The loop ends at ``max_depth``, when nothing new is found, or once more than
    ``max_discovered`` nodes are known; each level is a written table, so a lost executor costs no
    recomputation of earlier levels, and only counts reach the driver.
    """
    # every level reads the links: distinct once, and written
    edges = stage(edges.select("src", "dst").where("src is not null and dst is not null").distinct(), "bfs-edges")
    seen = stage(start.select("node", F.lit(0).alias("depth")).distinct(), "bfs")
    frontier = seen
    known = seen.count()
    for depth in range(1, max_depth + 1):
        follow = frontier if leaf is None else frontier.where(~leaf)
        found = follow.join(edges, follow.node == edges.src).select(F.col("dst").alias("node")).distinct()
        frontier = stage(found.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)), "bfs")
        n = frontier.count()
        if not n:
            break
        seen = seen.unionByName(frontier)
        known += n
        if max_discovered is not None and known > max_discovered:
            break
    return seen


def fetch_order(nodes: DataFrame, priority: Column) -> DataFrame:
    """The nodes in the order in which they are to be fetched: priority pages first, then by depth."""
    return nodes.withColumn("priority", priority).orderBy(F.desc("priority"), "depth", "node")
