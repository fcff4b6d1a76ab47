"""Reports and choices per cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cluster_sizes(members: DataFrame, cluster: str = "cluster_id", least: int = 2) -> DataFrame:
    """(cluster, size) of the clusters with at least ``least`` members."""
    return members.groupBy(cluster).agg(F.count("*").alias("size")).where(F.col("size") >= least)


def size_statistics(sizes: DataFrame, size: str = "size") -> DataFrame:
    """count, min, max, mean, median and mode (smallest of equally frequent); NULL on empty input, count 0."""
    return sizes.agg(
        F.count(size).alias("n"), F.min(size).alias("min"), F.max(size).alias("max"),
        F.round(F.avg(size), 6).alias("mean"), F.median(size).alias("median"), F.mode(size, True).alias("mode"),
    )


def size_histogram(sizes: DataFrame, size: str = "size") -> DataFrame:
    return sizes.groupBy(size).agg(F.count("*").alias("n")).orderBy(size)


def largest_clusters(members: DataFrame, cluster: str, key: str, preview: int = 5) -> DataFrame:
    """(cluster, size, preview) with the first members by key, in descending order of size.

    The preview keeps a bounded list while it aggregates: only rows ranked within it are collected.
    """
    from pyspark.sql import Window

    ranked = members.withColumn("_at", F.row_number().over(Window.partitionBy(cluster).orderBy(key))).where(F.col("_at") <= preview)
    few = ranked.groupBy(cluster).agg(F.sort_array(F.collect_list(key)).alias("preview"))
    sizes = members.groupBy(cluster).agg(F.count("*").alias("size"))
    return sizes.join(few, cluster).orderBy(F.desc("size"), cluster)


def pick_largest(size: Column, key: Column) -> Column:
    """Aggregate: key of the row with the greatest size; NULL counts as 0, ties go to the greatest key."""
    return F.max_by(key, F.struct(F.coalesce(size, F.lit(0)), key))


def collect_members(members: DataFrame, cluster: str, key: str) -> DataFrame:
    """Long form to one sorted array of distinct members a cluster."""
    return members.groupBy(cluster).agg(F.sort_array(F.collect_set(key)).alias("members"))


def pair_total(n: Column) -> Column:
    return (n * (n - 1) / 2).cast("bigint")
