"""Connected components by random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); nodes of one component share a root.

    Each round every node points to the neighbour, or itself, of least rank in a
    random order, and edges are carried over to where their ends point. A fixed
    share of nodes goes away per round, so rounds grow with the logarithm of the
    longest path. All steps are joins and combined aggregations on written
    tables; neither edges nor nodes come to the driver.
    """
    edges = written(edges.filter("a != b").distinct(), "edges")
    steps = []
    while True:
        rank = F.xxhash64(F.lit(len(steps)), "node")
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        ordered = F.struct(F.xxhash64(F.lit(len(steps)), "other").alias("rank"), F.col("other").alias("id"))
        nearest = both.groupBy("node").agg(F.min(ordered).alias("least"))
        own = F.struct(rank.alias("rank"), F.col("node").alias("id"))
        step = written(nearest.select("node", F.least("least", own)["id"].alias("root")), "step")
        steps.append(step)
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(
            step.select(F.col("node").alias("b"), F.col("root").alias("y")), "b"
        )
        edges = written(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a != b").distinct(), "edges")
        if edges.isEmpty():
            break
    found = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
