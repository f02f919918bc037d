"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum (partially aggregated before its shuffle) and a join
with those minima.  Edges and minima are written tables, so both sides of the join are
shuffled for it alone and Spark splits the partition of a node with very many
neighbours where it is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.llm.common import Workspace


def _least(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(w, m): the smallest neighbour below each node that has one."""
    return work.table(edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), name)


def _step(edges: DataFrame, work: Workspace, label: str) -> DataFrame:
    """Both stars over edges u > v, as one new table of edges."""
    # Large star: neighbours above a node move to the node's least; a node without one below is that itself.
    least = _least(edges, work, f"{label}-least")
    large = edges.join(least, edges["v"] == least["w"], "left").select("u", F.coalesce("m", "v").alias("v"))
    large = work.table(large, f"{label}-large")
    # Small star: neighbours below a node move to the least of them, and so does the node.
    least = _least(large, work, f"{label}-low")
    moved = large.join(least, large["u"] == least["w"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    after = work.table(moved.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), label)
    work.drop(f"{label}-least", f"{label}-large", f"{label}-low")
    return after


def _stamp(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, work: Workspace, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is its smallest node.

    Self-loops and repeated edges count for nothing; an empty table gives an empty table.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = work.table(now, f"{label}-0")
    stamp, k = _stamp(now), 0
    while stamp[0]:
        after = _step(now, work, f"{label}-{k + 1}")
        work.drop(f"{label}-{k}")
        k += 1
        now, (before, stamp) = after, (stamp, _stamp(after))
        if stamp == before:
            break
    # At the fixed point every edge is (node, smallest node of its component).
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
