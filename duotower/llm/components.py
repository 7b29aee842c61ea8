"""Connected components of an edge table by alternating large and small stars.

Each star step is a group minimum and a join on the node, so a node with very many edges is never gathered in one
place, and every step's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duotower.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its least node, which is listed too."""
    step = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    seen = None
    while True:
        state = step.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or state[0] == 0:
            break
        seen = tuple(state)
        step = written(_small_star(_large_star(step).distinct()).distinct(), "components")
    return step.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        step.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
