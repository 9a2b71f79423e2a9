"""Connected components of an edge table, as rounds of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarrystone.llm._base import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over edges (a, b), for every node that has an edge.

    Each round every node points to its smallest neighbour, if that is smaller; pointers are
    doubled until they end at roots, and the edges are rewritten to the roots. Edges inside a
    tree vanish, so the trees at least halve each round, and rounds end when no edge is left.
    Doubling takes a logarithm of the longest chain. Groupings combine on the map side and
    joins are ordinary ones, so a node with very many edges is split by adaptive execution.
    Nothing is collected but counts.
    """
    e = checkpointed(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    moves = None
    while not e.isEmpty():
        both = e.select(F.col("a").alias("node"), F.col("b").alias("to")).unionAll(e.select("b", "a"))
        step = checkpointed(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to")))
        while True:
            ahead = step.select(F.col("node").alias("to"), F.col("to").alias("root"))
            double = checkpointed(step.join(ahead, "to").select("node", "to", "root"))
            moved = not double.filter("root <> to").isEmpty()
            step = double.select("node", F.col("root").alias("to"))
            if not moved:
                break
        step = step.withColumnRenamed("to", "root")
        moves = step if moves is None else checkpointed(
            moves.select("node", F.col("root").alias("mid")).join(step.select(F.col("node").alias("mid"), "root"), "mid", "left")
            .select("node", F.coalesce("root", "mid").alias("root"))
        )
        a = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        b = step.select(F.col("node").alias("b"), F.col("root").alias("y"))
        e = checkpointed(e.join(a, "a").join(b, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if moves is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return moves
