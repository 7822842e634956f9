"""Connected components by alternating large-star and small-star steps.

Each step is a partially aggregated minimum and one join. The minima are written before the join, so that
both its sides are plain shuffles and Spark may split a node that holds a large part of the edges. Nothing
but a count and a checksum per round reaches the driver. Rounds are cut by written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import Space


def _large(edges: DataFrame, space: Space) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = space.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
    return space.write(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")


def _small(edges: DataFrame, space: Space) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = space.write(down.groupBy("u").agg(F.min("v").alias("m")), "low")
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return space.write(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge between different nodes; root is the smallest node it is connected with, and is not listed itself."""
    space = Space(edges.sparkSession, "components")
    e = space.write(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        if e.isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        e = _small(_large(e, space), space)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).collect()[0]
        if now == mark:
            out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            space.drop(*(df for df, _ in space.paths.values() if df is not e))
            return out
        mark = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
