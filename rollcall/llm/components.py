"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import BROADCAST_ROWS, staged


def _is_forest(edges: DataFrame, least: DataFrame, nodes: int) -> bool:
    """Whether each node has one other, and that is no node itself."""
    if edges.count() != nodes:
        return False
    return edges.join(least, edges["other"] == least["_node"], "left_semi").isEmpty()


def _round(edges: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    """One large-star and one small-star step over edges from a node to a lesser other.

    Large-star gives each node its others' least others, so every edge stays one row of its node;
    the nodes stay the same too, and ``small`` holds for both joins.
    """
    side = F.broadcast if small else lambda df: df
    large = edges.join(side(least), F.col("other") == F.col("_node"), "left").select(
        "node", F.coalesce("least", "other").alias("other")
    )
    lowest = large.groupBy(F.col("node").alias("_own")).agg(F.min("other").alias("lowest"))
    starred = large.join(side(lowest), F.col("node") == F.col("_own"))
    linked = [F.struct(F.col(c).alias("node"), F.col("lowest").alias("other")) for c in ("other", "node")]
    return starred.select(F.explode(F.array(*linked)).alias("e")).select("e.*").where("node != other").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b bigint); root is the component's least node.

    Each step is an aggregation, whose partial form shrinks a hub's edges per task, and an
    equi-join.  Up to ``BROADCAST_ROWS`` nodes the join is a broadcast, which saves a round four
    of its shuffles, and the driver what it keeps of their tasks; beyond, it is a shuffle that
    adaptive execution splits where a hub is large.  Steps are staged in the shared scratch
    folder, so lineage stays short, and end as soon as the edges are stars.  Self links and
    repeated links do nothing.
    """
    a, b = F.col("a"), F.col("b")
    edges = staged(
        links.where(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other")).distinct(),
        "component-edges",
    )
    while True:
        least = edges.groupBy(F.col("node").alias("_node")).agg(F.min("other").alias("least"))
        least = staged(least, "component-least")
        nodes = least.count()
        if _is_forest(edges, least, nodes):
            break
        edges = staged(_round(edges, least, nodes <= BROADCAST_ROWS), "component-edges")
    roots = edges.select("node", F.col("other").alias("root"))
    return roots.union(edges.select(F.col("other"), F.col("other"))).distinct()
