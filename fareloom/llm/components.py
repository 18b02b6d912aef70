"""Connected components of an edge table, as joins: contract to the smallest neighbour, round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.sources.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _hook(edges: DataFrame) -> DataFrame:
    """node -> to: the smallest of itself and its neighbours, followed twice."""
    near = _both_ways(edges).groupBy("a").agg(F.min("b").alias("b"))
    near = stage(near.select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "hook")
    further = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
    jumped = near.join(further, "to").select("node", F.col("next").alias("to"))
    last = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
    return jumped.join(last, "to").select("node", F.col("next").alias("to"))


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of the edges (a, b); component is the smallest node reached.

    Each round maps nodes to a smaller neighbour and drops edges inside the merged nodes, so the
    edge table shrinks; labels that look random need about log(longest path) rounds. Each round's
    tables are written to the shared folder: lineage stays short and a lost executor costs its tasks.
    """
    left = stage(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        to = stage(_hook(left), "to")
        if labels is None:
            labels = to.select("node", F.col("to").alias("component"))
        else:
            step = to.select(F.col("node").alias("component"), "to")
            moved = labels.join(step, "component", "left")
            labels = stage(
                moved.select("node", F.coalesce("to", "component").alias("component")), "labels"
            )
        a = to.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        b = to.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = left.join(a, "a").join(b, "b").filter("ta <> tb")
        left = stage(moved.select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return labels
