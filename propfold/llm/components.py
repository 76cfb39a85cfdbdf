"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.llm.staging import stage

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links(a, b)``; component is the smallest id.

    Each round sends the larger neighbours of every id to the smallest one, then the
    smaller ones. Both are a combining minimum and a join on the id, so that a hub with
    a third of all links leaves each task as one row and its join can be split. Rounds
    grow with the logarithm of the longest path. No links give no rows.
    """
    edges = links.select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    ).where("hi <> lo").distinct()
    edges, before = stage(edges, "edges"), None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if state == before or not state[0]:
            break
        before = state
        edges = stage(small_star(large_star(edges)), "edges")
    else:
        raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")
    members = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return members.union(members.select(F.col("component").alias("id"), "component").distinct())


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def small_star(edges: DataFrame) -> DataFrame:
    edges = edges.distinct()
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()
