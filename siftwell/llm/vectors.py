"""Usable vectors of points, one record a point, copies set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column, dim: int) -> Column:
    """True for ``dim`` finite numbers that are not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) == dim) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def point_vectors(points: DataFrame, dim: int = 64) -> DataFrame:
    """(id, arrived, vec): one record per point with a usable vector; arrived is its smallest idx."""
    vec = F.col("text_info.text_vector")
    good = points.where("id is not null").select("id", "idx", vec.alias("vec")).where(usable(F.col("vec"), dim))
    return good.groupBy("id").agg(F.min("idx").alias("arrived"), F.first("vec").alias("vec"))


def point_batches(points: DataFrame, dim: int = 64) -> DataFrame:
    """point_vectors with batch_no, the batch that brought the smallest idx."""
    vec = F.col("text_info.text_vector")
    good = points.where("id is not null").select("id", "idx", "batch_no", vec.alias("vec")).where(usable(F.col("vec"), dim))
    first = good.groupBy("id").agg(F.min(F.struct("idx", "batch_no")).alias("f"), F.first("vec").alias("vec"))
    return first.select("id", F.col("f.idx").alias("arrived"), F.col("f.batch_no").alias("batch_no"), "vec")


def first_of_copies(vectors: DataFrame, order: str) -> DataFrame:
    """(order, vec): of records with equal numbers only that with the least ``order``; combined before the shuffle."""
    return vectors.groupBy("vec").agg(F.min(order).alias(order)).select(order, "vec")


def hashed_sample(rows: DataFrame, key: str, size: int, total: int) -> DataFrame:
    """At most ``size`` of about ``total`` rows, the first by a hash of the key.

    Rows far beyond the sample are filtered in the scan, so the tasks together send about twice ``size``
    rows to the driver, not ``size`` rows each.
    """
    share = min(1.0, 2 * size / max(total, 1))
    ranked = rows.withColumn("_rank", F.pmod(F.xxhash64(key), F.lit(1 << 40)))
    kept = ranked.where(F.col("_rank") < int(share * (1 << 40))) if share < 1 else ranked
    return kept.orderBy("_rank", key).limit(size).drop("_rank")
