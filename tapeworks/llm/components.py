"""Connected components by alternating large-star and small-star steps.

Each step is one grouped minimum and one join on the edges; no task sees a
component and nothing is collected. The number of steps grows with the
logarithm of the longest chain. Joins on a star's centre are ordinary
sort-merge joins whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeworks.llm.common import drop_table, keep_table


def _directed(edges: DataFrame) -> DataFrame:
    """Every edge as (v, u) with v > u, once."""
    return (edges.select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u"))
            .where(F.col("u") < F.col("v")).distinct())


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return near.where(F.col("v") > F.col("u")).join(least, "u").select("v", F.col("m").alias("u"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionByName(least.select("v", F.col("m").alias("u")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v); the component is the
    smallest node reachable. Nodes without an edge to another are absent."""
    now = keep_table(_directed(edges), "edges")
    while True:
        # Done when no node is both a child and a parent and no child has two parents.
        parents = now.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        many = parents.where(F.col("n") > 1).limit(1)
        chain = now.select(F.col("u").alias("v")).join(parents, "v", "left_semi").limit(1)
        if many.isEmpty() and chain.isEmpty():
            break
        last, now = now, keep_table(_directed(_small_star(_directed(_large_star(now)))), "edges")
        drop_table(last)
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)
