"""Connected components of a graph of longs, by contraction.

In each round every node hooks to its smallest neighbour, chains of hooks are shortened by pointer jumping, and the edges are
redrawn between roots; stars and chains end after one or two rounds. All state is in tables of the shared folder; the driver
only asks whether any edge or any change is left. Hot nodes (the hub of a large group) are aggregated before the shuffle, and
the joins have an exchange directly below each side, so adaptive execution can split them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B


def _flat(parents: DataFrame) -> DataFrame:
    """Each node's root instead of its parent."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = B.written(parents.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")), "jumped")
        moved = B.has(jumped.where("moved"))
        B.drop(parents)
        parents = jumped.select("node", "parent")
        if not moved:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of all nodes that an edge (a, b) of edges touches."""
    tidy = lambda e: e.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = B.written(tidy(edges), "edges")
    labels = None
    while B.has(left):
        ends = left.select(F.col("a").alias("node"), F.col("b").alias("to")).unionAll(left.select(F.col("b").alias("node"), F.col("a").alias("to")))
        parents = _flat(B.written(ends.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("parent")), "parents"))
        of = lambda c, parents=parents: parents.select(F.col("node").alias(c), F.col("parent").alias(f"root_{c}"))
        redrawn = B.written(tidy(left.join(of("a"), "a").join(of("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "edges")
        B.drop(left)
        left = redrawn
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("root"))
        else:
            labels = B.written(labels.join(parents.select(F.col("node").alias("root"), "parent"), "root", "left").select("node", F.coalesce("parent", "root").alias("root")), "labels")
    if labels is None:
        return B.empty(edges.sparkSession, "node long, root long")
    return labels
