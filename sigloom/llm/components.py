"""Connected components of an edge table, by contraction along edges to the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label): each node of edges (a, b) with the least node it can reach. Loops name no node.

    In a round every node chooses its least neighbour, in the order of nodes at first,
    afterwards in an order drawn anew by hash, and moves to the choice of its choice; two
    nodes that chose each other move to the lesser. Edges are then drawn between where their ends moved,
    and what has no edge left is done. Whatever the nodes' names and the graph's shape, a
    round leaves about half of the nodes of a path, fewer of others and one of a star; so rounds are
    about log2 of the nodes at most and the rounds together cost little more than the first. It ends
    when no edge is left: there is no cap.

    The moves of all rounds are then followed backwards, from the few last ones to the nodes. Every
    round's table is written; minima are combined before their shuffle, and joins are
    between plain scans, so that a hub with many edges is split like any skewed join.
    """
    rest = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    moves: list[DataFrame] = []
    while not rest.isEmpty():
        both = rest.select("a", "b").union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        turn = F.xxhash64("b", F.lit(len(moves))) if moves else F.col("b")
        chosen = materialise(both.groupBy("a").agg(F.min(F.struct(turn.alias("turn"), "b")).alias("m")).select(F.col("a").alias("node"), F.col("m.b").alias("choice")), "choices")
        then = chosen.select(F.col("node").alias("choice"), F.col("choice").alias("next"))
        to = F.when(F.col("next") == F.col("node"), F.least("node", "choice")).otherwise(F.col("next"))
        moved = materialise(chosen.join(then, "choice").select("node", to.alias("to")), "moves")
        moves.append(moved)
        ends = rest.join(moved.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(moved.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
        rest = materialise(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not moves:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("label"))
    ends = moves.pop()
    while moves:
        on = ends.select(F.col("node").alias("to"), F.col("to").alias("last"))
        ends = materialise(moves.pop().join(on, "to", "left").select("node", F.coalesce("last", "to").alias("to")), "ends")
    least = ends.groupBy("to").agg(F.min("node").alias("label"))
    return materialise(ends.join(least, "to").select("node", "label"), "labels")
