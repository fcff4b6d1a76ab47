"""Items that appear together: pair counts, lift and conviction by basket collapsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.tags import plain_tags
from siftwell.runtime import Workspace


#: First items of a basket whose pairs one task enumerates.
STRETCH = 256


def current_records(points: DataFrame, *columns: str) -> DataFrame:
    """The current record of each point: latest updated_at, ties by the greater idx."""
    held = F.max_by(F.struct(*columns), F.struct("updated_at", "idx"))
    return points.where("id is not null").groupBy("id").agg(held.alias("r")).select("id", "r.*")


def collapse_baskets(records: DataFrame, items: str) -> DataFrame:
    """(items, weight): identical sorted distinct item arrays as one basket with its number of records."""
    return records.where(F.size(items) > 0).groupBy(F.col(items).alias("items")).agg(F.count("*").alias("weight"))


def pair_statistics(baskets: DataFrame, work: Workspace | None = None) -> DataFrame:
    """(tag_a, tag_b, n_ab, n_a, n_b, n, lift, conviction) of all pairs with tag_a < tag_b.

    Pairs are enumerated once per distinct basket and weighted; item counts come from the same baskets. The
    pairs of a wide basket are enumerated by several tasks, each for a stretch of its first items.
    conviction is that of a => b, NULL where it is unbounded. Baskets of one item count in n only.
    Empty input gives an empty result.
    """
    work = work or Workspace(baskets.sparkSession, "pairs")
    kept = work.save(baskets)
    n = kept.agg(F.sum("weight")).first()[0] or 0
    single = kept.select(F.explode("items").alias("tag"), "weight").groupBy("tag").agg(F.sum("weight").alias("k"))
    narrow = kept.where(F.size("items") <= STRETCH).select("items", "weight", F.lit(0).alias("stretch"))
    wide = kept.where(F.size("items") > STRETCH)
    wide = wide.select("items", "weight", F.explode(F.sequence(F.lit(0), F.floor((F.size("items") - 1) / STRETCH).cast("int"))).alias("stretch"))
    parts = narrow.unionByName(wide.repartition("items", "stretch"))
    own = F.posexplode(F.slice("items", F.col("stretch") * STRETCH + 1, F.lit(STRETCH))).alias("i", "tag_a")
    at = parts.select("items", "weight", "stretch", own)
    pairs = at.select("tag_a", F.explode(F.expr(f"slice(items, stretch * {STRETCH} + i + 2, size(items))")).alias("tag_b"), "weight")
    counts = pairs.groupBy("tag_a", "tag_b").agg(F.sum("weight").alias("n_ab"))
    full = counts.join(single.select(F.col("tag").alias("tag_a"), F.col("k").alias("n_a")), "tag_a").join(
        single.select(F.col("tag").alias("tag_b"), F.col("k").alias("n_b")), "tag_b"
    )
    total = F.lit(n).cast("bigint")
    missed = F.col("n_a") - F.col("n_ab")
    double = lambda c: F.col(c).cast("double")
    return full.select(
        "tag_a", "tag_b", "n_ab", "n_a", "n_b", total.alias("n"),
        F.round(double("n_ab") * total / (double("n_a") * double("n_b")), 6).alias("lift"),
        F.when(missed > 0, F.round(double("n_a") * (1 - F.col("n_b") / total) / missed, 6)).alias("conviction"),
    )


def frequent_pairs(stats: DataFrame, least_count: int = 3, least_lift: int = 3) -> DataFrame:
    """Pairs on at least ``least_count`` records and ``least_lift`` times more often than chance, in whole numbers."""
    lifted = F.col("n_ab").cast("decimal(38,0)") * F.col("n") >= F.lit(least_lift) * F.col("n_a").cast("decimal(38,0)") * F.col("n_b")
    return stats.where((F.col("n_ab") >= least_count) & lifted)


def point_tag_pairs(points: DataFrame) -> DataFrame:
    """Pair statistics over the tags of the current record of every point."""
    tags = current_records(points, "categories").select(plain_tags(F.col("categories")).alias("tags"))
    return pair_statistics(collapse_baskets(tags, "tags"))
