"""Connected components by alternating star contractions over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.runtime import Workspace


def star_components(edges: DataFrame, work: Workspace | None = None) -> DataFrame:
    """(x, root) for every vertex of ``edges`` (u, v with u <> v); root is the least vertex of its component.

    Large-star and small-star steps (Kiveris et al., 2014) until the edges no longer change. Every step is
    written out, so rounds do not pile up lineage and a lost executor costs one step at most.
    """
    work = work or Workspace(edges.sparkSession, "components")
    current, before, first = edges.select("u", "v"), None, True
    seen = {"rows": F.count(F.lit(1)), "mark": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select("v", F.col("m").alias("u")).where("u <> v").distinct()
        low = large.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y"))
        low_min = low.groupBy("x").agg(F.min("y").alias("m"))
        small = low.join(low_min, "x").select("m", F.explode(F.array("x", "y")).alias("v")).where("v <> m")
        after = work.save(small.select(F.col("m").alias("u"), "v").distinct(), **seen)
        mark = work.metric(after), work.metric(after, "mark")
        if not first:
            work.drop(current)
        current, first = after, False
        if mark == before or not mark[0]:
            break
        before = mark
    child = current.select(F.col("v").alias("x"), F.col("u").alias("root"))
    return child.unionByName(current.select(F.col("u").alias("x"), F.col("u").alias("root")).distinct())


def component_labels(nodes: DataFrame, edges: DataFrame, node: str, a: str, b: str, label: str = "cluster_id") -> DataFrame:
    """(node, label) with the least node of the component as label; nodes without an edge keep themselves."""
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    roots = star_components(pairs).withColumnRenamed("x", node)
    return nodes.select(node).distinct().join(roots, node, "left").select(node, F.coalesce("root", node).alias(label))
