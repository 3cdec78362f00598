"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowrelay.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node that has an edge.

    ``edges`` has two columns of one type. Returns (node, root). Each round puts the nodes
    in a new random order, by a hash, maps every node to the first one within two steps,
    itself included, and replaces the edges by those between the images. A star or a
    small group is done in one round, and any graph shrinks by a constant factor a round,
    so a path takes as many rounds as the logarithm of its length. The rounds' maps are
    then applied one after the other, and each image's smallest node is its root. A node
    with a huge number of neighbours is a partial minimum in each task and a join key that
    adaptive execution splits.

    Null ends and edges from a node to itself are ignored. No edges give no rows.
    """
    a, b = edges.columns
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    left = saved(left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    steps = []
    while not left.isEmpty():

        def place(node: str, turn: int = len(steps)):
            return F.struct(F.xxhash64(node, F.lit(turn)).alias("at"), F.col(node).alias("node"))

        first = left.groupBy("a").agg(F.min(place("b")).alias("low")).select("a", F.least(place("a"), "low").alias("low"))
        onward = left.join(first.select(F.col("a").alias("b"), "low"), "b").groupBy("a").agg(F.min("low").alias("next"))
        step = saved(onward.join(first, "a").select("a", F.least("low", "next")["node"].alias("low")), "step")
        steps.append(step)
        ends = left.join(step, "a").select(F.col("low").alias("x"), "b")
        ends = ends.join(step.select(F.col("a").alias("b"), F.col("low").alias("y")), "b").where("x <> y")
        left = saved(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0].select(F.col("a").alias("node"), F.col("low").alias("image"))
    for step in steps[1:]:
        onward = step.select(F.col("a").alias("image"), "low")
        found = found.join(onward, "image", "left").select("node", F.coalesce("low", "image").alias("image"))
    if len(steps) > 1:
        found = saved(found, "images")
    roots = found.groupBy("image").agg(F.min("node").alias("root"))
    return found.join(roots, "image").select("node", "root")
