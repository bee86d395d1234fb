"""Connected components by alternating large and small stars, as aggregates and joins.

No step gathers a component: a node's smallest neighbour is an aggregate that
combines on the map side, and the edges then meet it by a join that adaptive
execution can split. The state is written to the shared folder each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import discard, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge in `edges` (u, v): the label is the component's smallest node."""
    spark = edges.sparkSession
    state, path = materialise(edges.where("u <> v").select("u", "v").distinct(), "stars")
    seen = None
    while True:
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
        after, after_path = materialise(_small_star(_large_star(state)).distinct(), "stars")
        discard(spark, path)
        state, path = after, after_path
    # every node but the smallest has one edge, to the smallest
    return state.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
