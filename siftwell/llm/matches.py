"""Consolidation of pairwise matches into groups.

Vertices of degree one are stripped and chains of degree-two vertices are compressed by list ranking
(independent-set contraction), round by round; the reduced core, in which every vertex has three or
more neighbours, is solved by alternating large-star and small-star steps; at last every removed vertex
takes over the label of the vertex it was attached to, by pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.operators.components import star_components
from siftwell.runtime import Workspace


def undirected_edges(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct (u, v) with u < v; NULL ends and self pairs are left out."""
    return (
        pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
        .distinct()
    )


def _light_vertices(edges: DataFrame) -> DataFrame:
    """Vertices with one or two neighbours as (x, a, b), b NULL for one; combined before the shuffle."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("v").alias("y")), F.struct(F.col("v").alias("x"), F.col("u").alias("y")))).alias("e")).select("e.*")
    light = ends.groupBy("x").agg(F.count("*").alias("d"), F.min("y").alias("a"), F.max("y").alias("b")).where("d <= 2")
    return light.select("x", "a", F.when(F.col("d") == 2, F.col("b")).alias("b"))


def _independent(light: DataFrame, salt: int) -> DataFrame:
    """Those light vertices whose rank is the least among themselves and their light neighbours.

    Every light vertex sends its rank to its neighbours; the message sums need no join, so a hub that
    is the neighbour of a third of all vertices costs one combined row a partition.
    """
    rank = F.struct(F.xxhash64("x", F.lit(salt)).alias("h"), F.col("x").alias("x"))
    own = F.struct(F.col("x").alias("to"), F.col("a"), F.col("b"), F.lit(None).cast("struct<h:bigint,x:%s>" % light.schema["x"].dataType.simpleString()).alias("near"))
    send = lambda c: F.struct(F.col(c).alias("to"), F.lit(None).cast(light.schema["a"].dataType).alias("a"), F.lit(None).cast(light.schema["a"].dataType).alias("b"), rank.alias("near"))
    messages = light.select(F.explode(F.array(own, send("a"), send("b"))).alias("m")).select("m.*").where("to is not null")
    met = messages.groupBy("to").agg(F.max("a").alias("a"), F.max("b").alias("b"), F.min("near").alias("near"))
    mine = F.struct(F.xxhash64("to", F.lit(salt)).alias("h"), F.col("to").alias("x"))
    return met.where(F.col("a").isNotNull() & (F.col("near").isNull() | (mine < F.col("near")))).select(F.col("to").alias("x"), "a", "b")


def _contract(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """Edges without the removed vertices; a removed chain link leaves an edge between its neighbours."""
    order = lambda p, q: F.struct(F.least(p, q).alias("u"), F.greatest(p, q).alias("v"))
    cut = gone.select(F.explode(F.array(order("x", "a"), F.when(F.col("b").isNotNull(), order("x", "b")))).alias("e")).where("e is not null").select("e.*")
    kept = edges.join(cut, ["u", "v"], "left_anti")
    bridges = gone.where("b is not null").select(order("a", "b").alias("e")).select("e.*")
    return kept.unionByName(bridges).distinct()


def match_groups(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, group_id) for every vertex of a pair; group_id is the smallest id of its component.

    NULL ends and pairs of a vertex with itself are no pairs, repeated pairs and both directions count
    once, an empty input gives an empty result. All state stays in written tables; the driver sees
    counts only. Other columns of ``pairs`` are ignored, whatever their names.
    """
    spark = pairs.sparkSession
    work = Workspace(spark, "groups")
    number = F.count(F.lit(1))  # taken in the job that writes
    edges = start = work.save(undirected_edges(pairs, a, b), rows=number)
    attached: DataFrame | None = None
    salt = 0
    while work.metric(edges):
        gone = work.save(_independent(_light_vertices(edges), salt), rows=number)
        if not work.metric(gone):
            break
        link = gone.select("x", F.col("a").alias("parent"))
        attached = link if attached is None else attached.unionByName(link)
        after = work.save(_contract(edges, gone), rows=number)
        if edges is not start:
            work.drop(edges)
        edges, salt = after, salt + 1
    roots = None if not work.metric(edges) else work.save(star_components(edges, work))
    if attached is None:
        attached = start.select(F.col("u").alias("x"), F.col("v").alias("parent")).limit(0)
    pointers = work.save(attached)
    steps = 1
    while steps < salt:  # a parent was removed in a later round, so the depth is below the rounds
        up = pointers.select(F.col("x").alias("parent"), F.col("parent").alias("above"))
        after = work.save(pointers.join(up, "parent", "left").select("x", F.coalesce("above", "parent").alias("parent")))
        work.drop(pointers)
        pointers, steps = after, steps * 2
    tops = pointers.select("parent").distinct().withColumnRenamed("parent", "x")
    members = pointers.select("x", F.col("parent").alias("top")).unionByName(tops.select("x", F.col("x").alias("top")))
    if roots is not None:
        named = roots.select(F.col("x").alias("top"), "root")
        members = members.unionByName(roots.select("x", F.col("x").alias("top"))).distinct()
        members = members.join(named, "top", "left").select("x", F.coalesce("root", "top").alias("top"))
    members = work.save(members)
    least = members.groupBy("top").agg(F.min("x").alias("group_id"))
    return members.join(least, "top").select(F.col("x").alias("id"), "group_id")
