"""Connected components over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import saved


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v") % (1 << 40)), F.lit(0)).alias("h")).first()
    return row.n, row.h


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or other smaller) neighbours, and itself, linked to its smallest neighbour."""
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = sides.join(least, "u")
    if large:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``u, v``; the root is the component's smallest node.

    Alternating large and small stars: a node's edges are aggregated to one minimum before they are
    shuffled, so a node with a third of all edges costs no more than they do. Each round is a table in the
    shared folder; the number of rounds grows with the logarithm of the component's size.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (signature := _signature(now)) != before:
        before = signature
        now = saved(_star(_star(now, True), False), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
