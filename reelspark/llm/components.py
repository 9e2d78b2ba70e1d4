"""Connected components of an edge table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark import scratch


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long); label: the smallest node reachable.

    Each round every node steps to the first of its neighbours and itself, and edges become those between the nodes stepped
    to, once each, loops dropped; it is over when none is left. First is the smallest in even rounds, which ends stars around their smallest
    node at once, and in odd rounds the first in an order drawn for the round: then some half of the nodes or more are
    not stepped to, whatever the shape. So rounds grow with the logarithm of the nodes at most, and later ones join only what is left.
    Going back, steps are followed to the node that stands for a component, which takes its smallest. First neighbours are combined in
    the map tasks, so a node with very many edges moves one row a task. Edges and steps of a round are tables in the shared
    folder, removed when they are read no more. Empty in, empty out.
    """

    def stored(pairs: DataFrame, level: int) -> DataFrame:
        once = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return scratch.written(once, f"{name}-edges-{level}")

    # A node that has only edges to itself is one of its own, and takes part in no round.
    lone = edges.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("label"))
    left, steps = stored(edges, 0), []
    while not steps or left.limit(1).count():
        near = left.toDF("node", "to").union(left.select("b", "a"))
        first = near.groupBy("node").agg(F.min(_placed("to", len(steps))).alias("to"))
        step = scratch.written(first.select("node", F.least("to", _placed("node", len(steps)))["id"].alias("to")), f"{name}-steps-{len(steps)}")
        steps.append(step)
        # Both sides are tables, so that a node that very many edges have can be split over tasks.
        moved = left.join(step.toDF("a", "to_a"), "a").join(step.toDF("b", "to_b"), "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        done, left = left, stored(moved, len(steps))
        scratch.removed(done)
    stands = steps[-1]
    for step in reversed(steps[:-1]):
        stands = step.join(stands.toDF("to", "further"), "to", "left").select("node", F.coalesce("further", "to").alias("to"))
    stands = scratch.written(stands, f"{name}-stands")
    smallest = stands.groupBy("to").agg(F.min("node").alias("label"))
    labels = scratch.written(stands.join(smallest, "to").select("node", "label").union(lone).groupBy("node").agg(F.min("label").alias("label")), f"{name}-labels")
    scratch.removed(left, stands, *steps)
    return labels


def _placed(column: str, level: int) -> Column:
    """A node with its place in the order of a round."""
    return F.struct((F.xxhash64(column, F.lit(level)) if level % 2 else F.col(column)).alias("place"), F.col(column).alias("id"))
