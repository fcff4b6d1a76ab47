"""Differences between consecutive full snapshots.

Identical rows of neighbouring snapshots cancel in a signed multiset count, which is EXCEPT ALL in
both directions at the price of one shuffle; what remains is full-joined by key and labelled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.paths import plain_etag, plain_path


def present_objects(listing: DataFrame) -> DataFrame:
    """One row per object and snapshot in which it is present, in plain notation.

    Present means a row with mode FILE that is not a delete marker; of several the one with the latest
    last_modified counts (NULL is oldest; equal times go by the greater length, then etag). A NULL
    ``is_deleted`` counts as false, a NULL path as no object. The aggregation combines before the
    shuffle, so an object repeated any number of times stays cheap.
    """
    rows = listing.where((F.col("mode") == "FILE") & ~F.coalesce(F.col("is_deleted"), F.lit(False))).select(
        "taken_at",
        "snapshot_no",
        plain_path("path").alias("path"),
        F.struct("last_modified", "content_length", plain_etag(F.col("etag")).alias("etag")).alias("state"),
    )
    return (
        rows.where("path is not null and taken_at is not null")
        .groupBy("taken_at", "path")
        .agg(F.max("state").alias("state"), F.max("snapshot_no").alias("snapshot_no"))
        .select("taken_at", "snapshot_no", "path", "state.*")
    )


def snapshot_order(listing: DataFrame) -> DataFrame:
    """taken_at, snapshot_no and a dense position, one row per delivered snapshot."""
    seen = listing.where("taken_at is not null").groupBy("taken_at").agg(F.max("snapshot_no").alias("snapshot_no"))
    return seen.withColumn("seq", F.row_number().over(Window.orderBy("taken_at")))


def signed_residues(rows: DataFrame, key: list[str], compared: list[str], last_seq: int) -> DataFrame:
    """EXCEPT ALL of each position against the one before, both ways at once.

    ``rows`` has ``seq`` (1-based position of the snapshot), key and compared columns. Every row stands
    for +1 at its own step and -1 at the following one; sums of zero are identical rows and go. The
    result has step, key, compared columns and ``sign`` (+1 only in the later, -1 only in the earlier).
    """
    sides = F.array(
        F.struct(F.col("seq").alias("step"), F.lit(1).alias("sign")),
        F.struct((F.col("seq") + 1).alias("step"), F.lit(-1).alias("sign")),
    )
    steps = (
        rows.select(*key, *compared, F.explode(sides).alias("side"))
        .select("side.*", *key, *compared)
        .where((F.col("step") > 1) & (F.col("step") <= last_seq))
    )
    return steps.groupBy("step", *key, *compared).agg(F.sum("sign").alias("sign")).where("sign <> 0")


def diff_snapshots(
    rows: DataFrame, key: list[str], compared: list[str], last_seq: int, differs: Callable[[Column, Column], Column]
) -> DataFrame:
    """(step, key..., change) with change in added, removed, changed.

    ``differs(before, after)`` gets two structs of the compared columns and tells whether a key that is
    present on both sides counts as changed. Empty input gives an empty result.
    """
    packed = F.struct(*compared)
    residue = signed_residues(rows, key, compared, last_seq).select("step", *key, "sign", packed.alias("row"))
    after = residue.where("sign > 0").select("step", *key, F.col("row").alias("after"))
    before = residue.where("sign < 0").select("step", *key, F.col("row").alias("before"))
    joined = after.join(before, ["step", *key], "full")
    change = (
        F.when(F.col("before").isNull(), F.lit("added"))
        .when(F.col("after").isNull(), F.lit("removed"))
        .when(differs(F.col("before"), F.col("after")), F.lit("changed"))
    )
    return joined.select("step", *key, change.alias("change")).where("change is not null").distinct()


def object_differs(before: Column, after: Column) -> Column:
    """Etag or length differ, or last_modified by a second or more; NULL on a side compares as equal."""
    seconds = F.abs(F.unix_micros(before["last_modified"]) - F.unix_micros(after["last_modified"])) >= 1_000_000
    no = F.lit(False)
    return (
        F.coalesce(before["etag"] != after["etag"], no)
        | F.coalesce(before["content_length"] != after["content_length"], no)
        | F.coalesce(seconds, no)
    )


def listing_changes(listing: DataFrame) -> DataFrame:
    """(snapshot_no, path, change) between each snapshot and the one taken before it.

    Only the positions of the snapshots come to the driver (one row per delivered snapshot); the first
    snapshot has no predecessor and gives no rows.
    """
    known = snapshot_order(listing).select(F.unix_micros("taken_at").alias("us"), "snapshot_no", "seq").collect()
    order = [(r["us"], r["snapshot_no"], r["seq"]) for r in known]
    table = listing.sparkSession.createDataFrame(order, "us bigint, snapshot_no int, seq int")
    positions = F.broadcast(table.select(F.timestamp_micros("us").alias("taken_at"), "snapshot_no", "seq"))
    rows = present_objects(listing).drop("snapshot_no").join(positions.select("taken_at", "seq"), "taken_at")
    found = diff_snapshots(
        rows.select("seq", "path", "etag", "content_length", "last_modified"),
        ["path"],
        ["etag", "content_length", "last_modified"],
        len(order),
        object_differs,
    )
    return found.join(positions.select("snapshot_no", F.col("seq").alias("step")), "step").select(
        "snapshot_no", "path", "change"
    )
