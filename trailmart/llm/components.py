"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.llm.common import delete, saved


def neighbours(edges: DataFrame) -> DataFrame:
    """node, low, high: the smallest and the largest neighbour of every node; one row per node."""
    both = edges.selectExpr("inline(array(named_struct('node', u, 'to', v), named_struct('node', v, 'to', u)))")
    return both.groupBy("node").agg(F.min("to").alias("low"), F.max("to").alias("high"))


def large_star(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours.

    The join has two plain sides, so AQE splits a node that has a large part of all edges.
    """
    joined = edges.join(ends.select(F.col("node").alias("v"), F.least("node", "low").alias("m")), "v")
    return joined.select("u", F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; as many rows as ``edges``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return edges.join(least, "u").select(moved.alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node with an edge (u, v).

    ``edges`` are read more than once, so they should be a stored table; repeated ones do no harm.
    Each round is written to the shared folder. Rounds grow with the logarithm of the
    number of nodes; what moves per round is at most the edges. They end when every node has
    either larger neighbours only or a single, smaller one: then all components are stars.
    """
    spark = edges.sparkSession
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    current, current_path = edges.where("u <> v").select(high, low), []
    while True:
        ends, ends_path = saved(neighbours(current), "components-ends")
        if ends.where("low < node and low < high").isEmpty():
            break
        following, next_path = saved(small_star(large_star(current, ends)), "components")
        delete(spark, ends_path, *current_path)
        current, current_path = following, [next_path]
    delete(spark, *current_path)
    return ends.select("node", F.least("node", "low").alias("root"))
