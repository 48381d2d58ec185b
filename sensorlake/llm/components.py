"""Connected components by alternating large-star and small-star steps: every step is a grouped
minimum and a join, so no component is ever gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node a, for its neighbours b > a: b is linked to the least of a and its neighbours."""
    pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that the join is planned afresh and a hub's many neighbours can be split.
    least = stored(pairs.groupBy("a").agg(F.min("b").alias("m"))
                   .select("a", F.least("a", "m").alias("m")), "cc-least")
    out = pairs.where("b > a").join(least, "a")
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node a, for its neighbours b < a: they and a are linked to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of longs in any direction -> (node, root): root is the least node of the
    component. Nodes without an edge to another node do not appear; nulls are no nodes."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                F.least("a", "b").alias("b")).distinct(),
                   "cc-edges")
    while True:
        # Done when the edges are stars: a node has one root, and no root has a root itself.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("roots"),
                            F.lit(0).alias("nodes")).unionByName(
            edges.select("b", F.lit(0), F.lit(1)).toDF("node", "roots", "nodes"))
        open_ = ends.groupBy("node").agg(F.sum("roots").alias("roots"),
                                         F.max("nodes").alias("nodes"))
        if open_.where("roots > 1 OR roots = 1 AND nodes = 1").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        large = stored(_large_star(edges), "cc-large")
        edges = stored(_small_star(large), "cc-edges")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` of the components after ``links`` (a, b) are added: only the graph between the
    components that they join is worked on."""
    of = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    between = links.join(of, "a", "left").withColumn("a", F.coalesce("ra", "a")).drop("ra")
    of = of.toDF("b", "rb")
    between = between.join(of, "b", "left").withColumn("b", F.coalesce("rb", "b"))
    moved = components(between.select("a", "b"))
    kept = roots.join(moved.toDF("root", "new"), "root", "left").select(
        "node", F.coalesce("new", "root").alias("root"))
    return kept.unionByName(moved)
