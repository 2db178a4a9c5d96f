"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteloom.sources.scratch import cut


def components(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex that each vertex reaches.

    ``edges`` (a, b) in any direction, ``vertices`` (v) distinct and holding all ends. In each round a
    vertex takes the smallest root among itself and its neighbours, then the root of that root.
    Rounds grow with the logarithm of the longest chain. Each round is a table, not a lineage.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    linked = both.select(F.col("a").alias("v")).distinct()
    state = cut(linked.select("v", F.col("v").alias("root")), "roots")
    while True:
        near = both.join(state.select(F.col("v").alias("b"), "root"), "b").groupBy(F.col("a").alias("v")).agg(
            F.min("root").alias("near")
        )
        step = state.join(near, "v").select("v", F.least("root", "near").alias("mid"), F.col("root").alias("was"))
        step = cut(step, "step")
        jump = step.select(F.col("v").alias("mid"), F.col("mid").alias("root"))
        after = cut(step.join(jump, "mid").select("v", F.least("mid", "root").alias("root"), "was"), "roots")
        state = after.select("v", "root")
        if after.where("root < was").isEmpty():
            break
    return vertices.select("v").join(state, "v", "left").select("v", F.coalesce("root", "v").alias("root"))
