"""Connected components of an edge table by repeated contraction; nothing is brought to the driver.

In a round every vertex points to its smallest neighbour if that is smaller than itself, pointers are
followed to their roots, and edges are rewritten to roots. The number of vertices left falls in every
round; each is written below the shared folder, so lineage stays short and executors may be lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import Staging, stage


def _roots(parents: DataFrame, keep: Staging) -> DataFrame:
    """``(node, up)`` with ``up`` followed until it no longer changes."""
    while True:
        above = parents.select(F.col("node").alias("up"), F.col("up").alias("next"))
        jumped = keep(parents.join(above, "up", "left").select(
            "node", F.coalesce("next", "up").alias("up"), (F.col("next") != F.col("up")).alias("moved")), "jump")
        parents = jumped.select("node", "up")
        if jumped.filter("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every vertex of ``edges (a, b)``; the label is the smallest vertex reachable.

    Loops and repeated edges do no harm. No edges: no rows.
    """
    with Staging(edges.sparkSession) as keep:
        edges = keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        labels = None
        while not edges.isEmpty():
            both = edges.union(edges.select("b", "a"))
            least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
            roots = _roots(keep(least.select("node", F.least("node", "up").alias("up")), "parents"), keep)
            if labels is None:
                labels = roots.withColumnRenamed("up", "label")
            else:
                above = roots.select(F.col("node").alias("label"), F.col("up").alias("next"))
                labels = keep(labels.join(above, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
            one = edges.join(roots.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            two = one.join(roots.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
            edges = keep(two.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
        if labels is None:
            return edges.sparkSession.createDataFrame([], "node long, label long")
        return stage(labels, "components")
