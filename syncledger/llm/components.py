"""Connected components of an edge table by hooking and pointer jumping.

Each round every label hooks onto the smallest label it is linked with, chains
of hooks are followed to their roots by joins that halve them, and the edges
are drawn anew between the roots; edges within one component vanish. Labels
only get smaller, so a component ends with its smallest node as label. Nothing
but counts reaches the driver, and every step is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the labels of their ends, without those inside one component."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    moved = edges.join(la, "a", "left").join(lb, "b", "left") \
        .select(F.coalesce("la", "a").alias("x"), F.coalesce("lb", "b").alias("y"))
    return moved.filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, label) with every chain of hooks followed to its end."""
    hooks = stored(hooks, "cc-hooks")
    while True:
        ends = hooks.select(F.col("node").alias("label"), F.col("label").alias("further"))
        ahead = stored(hooks.join(ends, "label", "left").select("node", "label", "further"), "cc-jump")
        if ahead.filter("further IS NOT NULL").isEmpty():
            return hooks
        hooks = ahead.select("node", F.coalesce("further", "label").alias("label"))


def add_edges(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label) of every node with an edge: ``labels`` (of edges added before) merged along ``edges`` (a, b)."""
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    fresh = ends if labels is None else ends.join(labels, "node", "left_anti")
    fresh = fresh.select("node", F.col("node").alias("label"))
    labels = stored(fresh if labels is None else labels.unionByName(fresh), "cc-labels")
    edges = stored(_relabelled(edges, labels), "cc-edges")
    while not edges.isEmpty():
        roots = _roots(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")))
        to = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = stored(labels.join(to, "label", "left").select("node", F.coalesce("root", "label").alias("label")),
                        "cc-labels")
        edges = stored(_relabelled(edges, roots), "cc-edges")
    return labels
