"""Connected components by contraction, as joins and aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.plans.shared import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is its smallest node.

    Each round moves every node to the smallest of itself and its neighbours
    and contracts the edges. A chain halves at least, so rounds grow with the
    logarithm of the longest path. The smallest node of a component never
    moves. Each round is a written table, so lineage stays short; aggregates
    are combined before the shuffle, so a node with many edges is no hot task.
    """
    both = lambda e: e.select("a", "b").union(e.select(F.col("b"), F.col("a")))
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    moves = []
    while True:
        move = both(edges).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        move = staged(move.select("node", F.least("node", "to").alias("to")), "moves")
        moves.append(move)
        if edges.isEmpty():
            break
        left = move.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = move.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = staged(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    result = moves[0]
    for move in moves[1:-1]:
        step = move.select(F.col("node").alias("to"), F.col("to").alias("next"))
        result = result.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    return staged(result.withColumnRenamed("to", "component"), "components")
