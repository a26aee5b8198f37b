"""Connected components of a graph given by its edges, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assocframe.plans.materialize import materialize


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours to its smallest neighbour, then its smaller ones.  Each step is
    one minimum per node and one join, and the number of rounds grows with the
    logarithm of the component's size.  Rounds are written to the checkpoint
    folder, so a lost executor costs one round at most.
    """
    now = materialize(_pairs(edges.filter("a <> b")))
    state = _summary(now)
    while True:
        now = materialize(_star(_star(now, larger=True), larger=False))
        after = _summary(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()


def _pairs(edges: DataFrame) -> DataFrame:
    """Each edge once, its larger end first."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours, and itself, to its smallest neighbour or itself."""
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    sides = down.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if larger else down
    least = sides.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = sides.join(least, "u")
    moved = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if larger else (
        linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    )
    return _pairs(moved.filter("a <> b"))
