"""What to keep, examine and delete in every cluster of near-duplicates, and the transfer of tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.vectors import norm
from siftwell.operators.clusters import pick_largest
from siftwell.operators.complete_link import complete_link
from siftwell.operators.similarity import IMAGE_THRESHOLD, TEXT_THRESHOLD
from siftwell.runtime import Workspace

KEEP_ACTIONS = ("kept_text", "kept_gif", "kept_non_gif")
DISCARD_ACTIONS = ("invalid_gif", "same_frame_gif", "duplicate_gif", "other_delete")


def _representatives(rows: DataFrame, least: float, vec: str) -> DataFrame:
    """(cluster_id, id) of the largest member of each complete-link part of every cluster."""
    keyed = rows.withColumn("member", F.struct("cluster_id", "id"))
    usable = keyed.where(F.col(vec).isNotNull() & (norm(F.col(vec)) > 0))
    linked = usable.select(F.concat_ws("/", F.col("cluster_id").cast("string"), "id").alias("k"), "cluster_id", vec)
    parts = complete_link(linked, "k", vec, least, group="cluster_id").withColumnRenamed("cluster_id", "part")
    named = rows.withColumn("k", F.concat_ws("/", F.col("cluster_id").cast("string"), "id")).join(parts, "k", "left")
    named = named.withColumn("part", F.coalesce("part", "k"))
    return named.groupBy("cluster_id", "part").agg(pick_largest(F.col("size"), F.col("id")).alias("id")).select("cluster_id", "id")


def triage_clusters(members: DataFrame, points: DataFrame, least: float = TEXT_THRESHOLD) -> DataFrame:
    """(cluster_id, id, action): every distinct member of a cluster gets exactly one action.

    ``points`` has id, size, ext, text_vector. Members with text form complete-link parts (above
    ``least``, in the order of ids); the largest of each part is kept_text. If all members have text, the
    rest is other_delete. Else GIFs (extension exactly 'gif') of the rest are gif_triage and the others
    other_delete; without a GIF the largest of the rest is kept_non_gif. Members without metadata have no
    text, no extension and size 0; ties go to the greatest id. A zero text vector resembles nothing.
    """
    work = Workspace(members.sparkSession, "triage")
    known = points.select("id", "size", "ext", "text_vector").dropDuplicates(["id"])
    rows = members.where("cluster_id is not null and id is not null").select("cluster_id", "id").distinct().join(known, "id", "left")
    rows = work.save(rows.select("cluster_id", "id", "size", "ext", "text_vector"))
    text = rows.where("text_vector is not null")
    kept = work.save(_representatives(text, least, "text_vector").withColumn("kept", F.lit(True)))
    marked = rows.join(kept, ["cluster_id", "id"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    is_gif = F.coalesce(F.col("ext") == "gif", F.lit(False))
    rest = ~F.col("kept")
    facts = marked.groupBy("cluster_id").agg(
        F.min(F.col("text_vector").isNotNull()).alias("all_text"),
        F.max(rest & is_gif).alias("has_gif"),
        F.max_by("id", F.when(rest, F.struct(F.coalesce("size", F.lit(0)), "id"))).alias("largest"),
    )
    action = (
        F.when(F.col("kept"), F.lit("kept_text"))
        .when(F.col("all_text"), F.lit("other_delete"))
        .when(F.col("has_gif"), F.when(is_gif, F.lit("gif_triage")).otherwise(F.lit("other_delete")))
        .when(F.col("id") == F.col("largest"), F.lit("kept_non_gif"))
        .otherwise(F.lit("other_delete"))
    )
    return marked.join(facts, "cluster_id").select("cluster_id", "id", action.alias("action"))


def settle_gifs(triaged: DataFrame, gifs: DataFrame, points: DataFrame, least: float = IMAGE_THRESHOLD) -> DataFrame:
    """(cluster_id, id, action) with gif_triage replaced by its outcome.

    ``gifs`` has id, status ('ok', 'same_frame' or an error) and embedding (mean of its frames). Same-frame
    ones are same_frame_gif, ones in error or without a row invalid_gif; the others form complete-link parts
    (above ``least``) whose largest is kept_gif, the rest duplicate_gif.
    """
    work = Workspace(triaged.sparkSession, "gifs")
    seen = gifs.select("id", "status", "embedding").dropDuplicates(["id"])
    open_ = work.save(triaged.where("action = 'gif_triage'").join(seen, "id", "left").join(points.select("id", "size").dropDuplicates(["id"]), "id", "left"))
    valid = open_.where("status = 'ok' and embedding is not null").select("cluster_id", "id", "size", "embedding")
    kept = work.save(_representatives(valid, least, "embedding").withColumn("kept", F.lit(True)))
    outcome = (
        F.when(F.col("status") == "same_frame", F.lit("same_frame_gif"))
        .when((F.col("status") == "ok") & F.col("embedding").isNotNull(), F.when(F.coalesce("kept", F.lit(False)), F.lit("kept_gif")).otherwise(F.lit("duplicate_gif")))
        .otherwise(F.lit("invalid_gif"))
    )
    settled = open_.join(kept, ["cluster_id", "id"], "left").select("cluster_id", "id", outcome.alias("action"))
    return triaged.where("action <> 'gif_triage'").unionByName(settled)


def final_classification(settled: DataFrame) -> DataFrame:
    """One row a cluster with a sorted array per action, NULL where it is empty."""
    lists = [F.sort_array(F.collect_list(F.when(F.col("action") == a, F.col("id")))).alias(a) for a in (*KEEP_ACTIONS, *DISCARD_ACTIONS)]
    wide = settled.groupBy("cluster_id").agg(*lists)
    return wide.select("cluster_id", *(F.when(F.size(a) > 0, F.col(a)).alias(a) for a in (*KEEP_ACTIONS, *DISCARD_ACTIONS)))


def tag_transfer(settled: DataFrame, points: DataFrame) -> DataFrame:
    """(cluster_id, id, op, categories): keepers get their own tags and all tags of their cluster's discards.

    op is 'upsert' for keepers (categories sorted and distinct) and 'delete' for discards (categories NULL).
    NULL categories are an empty set.
    """
    tags = settled.join(points.select("id", "categories").dropDuplicates(["id"]), "id", "left")
    keeper = F.col("action").isin(*KEEP_ACTIONS)
    shared = tags.where(~keeper).select("cluster_id", F.explode("categories").alias("tag")).groupBy("cluster_id").agg(F.collect_set("tag").alias("given"))
    nothing = F.array().cast("array<string>")
    merged = F.array_sort(F.array_union(F.coalesce("categories", nothing), F.coalesce("given", nothing)))
    joined = tags.join(shared, "cluster_id", "left")
    op = F.when(keeper, F.lit("upsert")).otherwise(F.lit("delete"))
    return joined.select("cluster_id", "id", op.alias("op"), F.when(keeper, merged).alias("categories"))


def apply_transfer(points: DataFrame, plan: DataFrame) -> DataFrame:
    """The points after the plan: upserts set categories, deleted ids are gone.

    A point that some cluster keeps is not deleted by another; several upserts of a point are united.
    """
    upsert = F.col("op") == "upsert"
    rows = plan.where("op in ('upsert', 'delete')").select("id", upsert.alias("kept"), F.explode_outer(F.when(upsert, F.col("categories"))).alias("tag"))
    fates = rows.groupBy("id").agg(F.max("kept").alias("kept"), F.array_sort(F.collect_set("tag")).alias("new_categories"))
    left = points.join(fates, "id", "left").where(F.coalesce("kept", F.lit(True)))
    return left.withColumn("categories", F.when(F.col("kept"), F.col("new_categories")).otherwise(F.col("categories"))).drop("kept", "new_categories")
