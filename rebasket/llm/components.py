"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every node's neighbours to the least node around it.

    Large-star moves the neighbours above a node, small-star those below it and
    the node itself. The least neighbour is found by an aggregate that combines
    in the map tasks; the join back holds the edges of one node in one task.
    """
    if large:
        around = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    else:
        around = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))  # u > v
    least = around.groupBy(F.col("x").alias("of")).agg(F.min("y").alias("least")).select(
        "of", F.least("of", "least").alias("least"))
    met = around.join(least, F.col("x") == F.col("of"))
    if large:
        moved = met.filter(F.col("y") > F.col("x")).select(F.col("y").alias("u"), F.col("least").alias("v"))
    else:
        moved = met.select(F.col("y").alias("u"), F.col("least").alias("v")).unionByName(
            least.select(F.col("of").alias("u"), F.col("least").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least node each node of ``edges`` (a, b: long) is connected to.

    Edges are stored after every round, since a lost executor would otherwise
    bring all rounds back; rounds grow with the logarithm of the nodes. Ends when a
    round changes nothing: then every node points at its component's least node.
    """
    edges = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stored(edges, "edges")
    state, going = None, not now.isEmpty()
    while going:
        # a node above its own neighbours' least node changes some edge, so equal sums mean equal edges
        now = stored(_star(_star(now, large=True), large=False), "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        state, going = tuple(found), tuple(found) != state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
