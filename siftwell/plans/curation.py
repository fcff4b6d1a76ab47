"""Queries of the curation operators: similarity, clustering, neighbours, triage, file repair, tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions import ids, images, paths, payload, tags, vectors
from siftwell.functions.frames import sampled_frames
from siftwell.functions.magic import detect_extension
from siftwell.operators import clusters, complete_link, components, density, extensions, knn, reduction, similarity, triage
from siftwell.plans.sql import path_sql, uuid_sql
from siftwell.runtime import Workspace, read_table
from siftwell.sources import point_table

#: Thresholds at which the embeddings table has a useful number of pairs; the operators default to 0.985 and 0.9.
EDGE, LINK, REACH = 0.4, 0.3, 0.6


def _embeddings(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "embeddings")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return similarity.similar_pairs(_embeddings(spark, d), "vec_id", "embedding", EDGE)


def near_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).select("a", "b", F.round("similarity", 6).alias("similarity"))


def near_dup_components(spark: SparkSession, d: str) -> DataFrame:
    return components.component_labels(_embeddings(spark, d), _edges(spark, d), "vec_id", "a", "b")


def component_sizes(spark: SparkSession, d: str) -> DataFrame:
    return clusters.cluster_sizes(near_dup_components(spark, d), least=1)


def complete_link_clusters(spark: SparkSession, d: str) -> DataFrame:
    return complete_link.complete_link(_embeddings(spark, d), "vec_id", "embedding", LINK, group="label")


def chunked_complete_link(spark: SparkSession, d: str) -> DataFrame:
    return complete_link.complete_link(_embeddings(spark, d), "vec_id", "embedding", LINK, order="vec_id", chunk_rows=100)


def dbscan(spark: SparkSession, d: str) -> DataFrame:
    return density.dbscan(_embeddings(spark, d), "vec_id", "embedding", REACH, 3)


def hdbscan(spark: SparkSession, d: str) -> DataFrame:
    return density.hdbscan(_embeddings(spark, d), "vec_id", "embedding")


def _sign_hashes(spark: SparkSession, d: str) -> DataFrame:
    return _embeddings(spark, d).select("vec_id", vectors.sign_bytes(F.col("embedding"), 64).alias("hash"))


def hamming_knn(spark: SparkSession, d: str) -> DataFrame:
    rows = _sign_hashes(spark, d)
    found = knn.knn_join(rows, rows, "vec_id", "hash", 20, "hamming_bits")
    return found.select("query_id", "neighbor_id", "rank", F.col("distance").cast("int").alias("distance"))


def knn_neighbour_set(spark: SparkSession, d: str) -> DataFrame:
    rows = _sign_hashes(spark, d)
    return knn.neighbour_set(knn.knn_join(rows, rows, "vec_id", "hash", 200, "hamming_share", most=0.75))


def query_knn(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of the vectors of one label by cosine distance."""
    rows = _embeddings(spark, d)
    found = knn.knn_join(rows.where("label = 3"), rows, "vec_id", "embedding", 10, "cosine")
    return found.select("query_id", "neighbor_id", "rank", F.round("distance", 6).alias("distance"))


def optics_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = _sign_hashes(spark, d)
    seeds = _embeddings(spark, d).where("label = 3").select("vec_id")
    sample = density.seeded_sample(rows, "vec_id", seeds, 200, seed=7)
    found = density.optics(sample, "vec_id", "hash", eps=20, metric="hamming_bits")
    return found


def pacmap_embedding(spark: SparkSession, d: str) -> DataFrame:
    """Ten dimensions of all vectors, with snapshots at eight steps."""
    return reduction.reduce_vectors(_embeddings(spark, d), "vec_id", "embedding", snapshots=(100, 200, 300, 400, 500, 600, 700, 800))


def sample_plus_seeds(spark: SparkSession, d: str) -> DataFrame:
    seeds = _embeddings(spark, d).where("label = 3").select("vec_id")
    return density.seeded_sample(_embeddings(spark, d).select("vec_id"), "vec_id", seeds, 200, seed=7)


def pairwise_graph(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of a listed id set with their similarity, whether it is low, and the ends' places on a circle."""
    rows = _embeddings(spark, d)
    listed = rows.where("label = 3").select("vec_id")
    pairs = similarity.pairs_of_ids(rows, listed, "vec_id", "embedding")
    from pyspark.sql import Window

    order = Window.orderBy("vec_id")
    n = listed.count()
    place = listed.select("vec_id", payload.layout_on_circle(F.row_number().over(order) - 1, F.lit(n), 1000).alias("p"))
    at = lambda c, x: place.select(F.col("vec_id").alias(c), F.col("p.x").alias(f"{x}_x"), F.col("p.y").alias(f"{x}_y"))
    out = pairs.join(at("a", "a"), "a").join(at("b", "b"), "b")
    return out.select("a", "b", F.round("similarity", 6).alias("similarity"), (F.col("similarity") < EDGE).alias("low"), "a_x", "a_y", "b_x", "b_y")


def cluster_size_stats(spark: SparkSession, d: str) -> DataFrame:
    return clusters.size_statistics(clusters.cluster_sizes(read_table(spark, d, "clusters")))


def cluster_size_histogram(spark: SparkSession, d: str) -> DataFrame:
    return clusters.size_histogram(clusters.cluster_sizes(read_table(spark, d, "clusters")))


def largest_clusters(spark: SparkSession, d: str) -> DataFrame:
    return clusters.largest_clusters(_members(spark, d), "cluster_id", "id")


def _members(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "clusters").select("cluster_id", ids.canonical_uuid("id").alias("id"))
    return rows.where("cluster_id is not null and id is not null").distinct()


def order_statistics(spark: SparkSession, d: str) -> DataFrame:
    sizes = read_table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("size"))
    return clusters.size_statistics(sizes)


def largest_line_per_order(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "lineitem")
    return rows.groupBy("l_orderkey").agg(clusters.pick_largest(F.col("l_quantity"), F.col("l_linenumber")).alias("l_linenumber"))


def top_lines_per_supplier(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    by_price = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    ranked = read_table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", F.row_number().over(by_price).alias("rank"))
    return ranked.where("rank <= 5")


def fetch_by_ids(spark: SparkSession, d: str) -> DataFrame:
    wanted = read_table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return point_table.points_by_ids(read_table(spark, d, "orders"), wanted, "o_custkey").select("o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"))


def ids_without_match(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders").select("o_orderkey")
    return orders.join(read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


def distinct_pairs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


def content_ids(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", ids.content_uuid(F.col("text").cast("binary")).alias("content_id"))


def exact_duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = content_ids(spark, d).groupBy("content_id").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))
    return rows.where("n > 1")


def _latest_files(spark: SparkSession, d: str) -> DataFrame:
    """(point_id, path, content_length): the newest present row of each file stem."""
    rows = read_table(spark, d, "object_listing").where("mode = 'FILE' and not coalesce(is_deleted, false) and path is not null")
    rows = rows.select(paths.plain_path("path").alias("path"), "taken_at", "content_length")
    # a stem is never NULL here; said so, a join on it does not filter on it below, which would work out path and stem twice
    stem = rows.select(F.coalesce(paths.file_stem(F.col("path")), F.lit("")).alias("point_id"), "path", "taken_at", "content_length")
    return stem.groupBy("point_id").agg(F.max(F.struct("taken_at", "path", "content_length")).alias("r")).select("point_id", "r.path", "r.content_length")


def _named_blobs(spark: SparkSession, d: str, ext: str) -> DataFrame:
    """First bytes of the blob points under the name they would be stored by."""
    rows = read_table(spark, d, "point_source").where("kind = 'blob'").select(ids.canonical_uuid("id").alias("id"), "blob_head").distinct()
    return rows.select(F.concat("id", F.lit(ext)).alias("path"), "blob_head")


def ext_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return extensions.extension_verdicts(_named_blobs(spark, d, ".jpg"), "path", "blob_head", "remote")


def ext_verdicts_local(spark: SparkSession, d: str) -> DataFrame:
    return extensions.extension_verdicts(_named_blobs(spark, d, ".GIF"), "path", "blob_head", "local")


def detected_types(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "point_source").where("blob_head is not null")
    return rows.groupBy(detect_extension(F.col("blob_head")).alias("ext")).agg(F.count("*").alias("n"))


def filtered_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "wrong_ext").select("row_id", paths.plain_path("path").alias("path")).distinct()
    return extensions.filter_paths(rows, include=["/raw/", "album"], exclude=[".gif"])


def _wrong(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "wrong_ext").select(paths.plain_path("path").alias("path"), "expected_ext").distinct()


def rename_plan(spark: SparkSession, d: str) -> DataFrame:
    return extensions.rename_plan(_wrong(spark, d), include=[("jpg", "png"), ("png", "jpg"), ("gif", "jpg")], skip=[("gif", "jpg")])


def payload_plan(spark: SparkSession, d: str) -> DataFrame:
    return extensions.payload_plan(_wrong(spark, d), "https://files.example.invalid")


def uri_for_points(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "object_listing").where("mode = 'FILE' and path is not null").select("prefix_key", paths.plain_path("path").alias("path")).distinct()
    rows = rows.join(read_table(spark, d, "uri_prefixes").select("prefix_key", "prefix"), "prefix_key", "left")
    stem, ext = paths.file_stem(F.col("path")), paths.name_extension(F.col("path"))
    return rows.select("path", paths.prefix_kind(F.col("prefix")).alias("kind"), paths.point_uri(F.col("prefix"), stem, ext).alias("uri"))


def payload_projection(spark: SparkSession, d: str) -> DataFrame:
    props = F.col("props")
    return read_table(spark, d, "events").select("event_id", ids.numeric_id_to_uuid(F.col("event_id")).alias("point_id"), payload.payload_int(props, "k").alias("k"))


def frame_sampling(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_quantity").cast("int")
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", sampled_frames(n).alias("frames"))


def vector_store_changes(spark: SparkSession, d: str) -> DataFrame:
    """A table of all vectors, some overwritten in place, some removed: ids, dense index and first coordinate."""
    rows = _embeddings(spark, d).select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vec"), "vec_id", "label")
    table = point_table.PointTable.builder(64).rows(rows, "vec_id").build(spark)
    swapped = rows.where("label = 1").withColumn("vec", F.reverse("vec"))
    table = table.insert(swapped, "vec_id").remove(rows.where("label = 2"))
    return table.rows.select("idx", "id", F.round(F.element_at("vec", 1).cast("double"), 6).alias("x"))


def current_points(spark: SparkSession, d: str) -> DataFrame:
    held = F.max_by(F.struct("height", "width", "weight", "size", "categories"), F.struct("updated_at", "idx"))
    rows = read_table(spark, d, "point_metadata").where("id is not null").groupBy("id").agg(held.alias("r"), F.first("text_info", ignorenulls=True).alias("text_info"))
    return rows.select("id", "r.height", F.coalesce("r.width", "r.weight").alias("width"), "r.size", "r.categories", "text_info")


def point_metadata(spark: SparkSession, d: str) -> DataFrame:
    rows = current_points(spark, d)
    return rows.select("id", "height", "width", "size", F.concat_ws("|", tags.plain_tags(F.col("categories"))).alias("categories"), F.col("text_info").isNotNull().alias("has_text"))


def _triage_points(spark: SparkSession, d: str) -> DataFrame:
    points = current_points(spark, d)
    vec = F.col("text_info.text_vector")
    files = _latest_files(spark, d).select(F.col("point_id").alias("id"), paths.last_segment_extension(F.col("path")).alias("ext"))
    return points.select("id", "size", F.when(F.size(vec) == 64, vec).alias("text_vector")).join(files, "id", "left")


def cluster_triage(spark: SparkSession, d: str) -> DataFrame:
    return triage.triage_clusters(_members(spark, d), _triage_points(spark, d))


#: Two colours, and the pictures that the animations below are made of.
_PALETTE = np.array([(20, 40, 60), (230, 200, 120)])


def _picture(kind: int, step: int) -> np.ndarray:
    """A 32 x 32 picture of stripes (0), checks (1) or a bar (2), moved by a step."""
    y, x = np.mgrid[0:32, 0:32]
    return [((x + 2 * step) // 4) % 2, ((x + 4 * step) // 8 + y // 8) % 2, ((x - 5 * step) % 32 < 6).astype(int)][kind]


def _animation(kind: int, frames: int, moving: bool = True) -> bytes:
    return images.encode_gif([_picture(kind, k if moving else 0) for k in range(frames)], _PALETTE)


#: Animations a task decodes: their ids are too few bytes for adaptive execution to give them more than a task or two.
_GIFS_A_TASK = 128


def _point_gifs(triaged: DataFrame, tasks: int) -> DataFrame:
    """(id, content): the animation of every point up for GIF triage, which the tables have not, in ``tasks`` partitions.

    The first character of the id says what it is: broken (0 to 3), one picture six times (4 to 7), moving
    stripes (8 to b) or a moving bar (c to f).
    """

    @F.pandas_udf("binary")
    def content(point: pd.Series) -> pd.Series:
        made = [b"GIF89a", _animation(0, 6, moving=False), _animation(0, 6), _animation(2, 6)]
        return point.map(lambda p: made[int(p[0], 16) // 4])

    wanted = triaged.where("action = 'gif_triage'").select("id").repartition(tasks, "id").distinct()
    return wanted.select("id", content("id").alias("content"))


def _settled(spark: SparkSession, d: str) -> DataFrame:
    work = Workspace(spark, "triage")
    triaged = work.save(triage.triage_clusters(_members(spark, d), _triage_points(spark, d)), gifs=F.count_if(F.col("action") == "gif_triage"))
    tasks = max(1, -(-work.metric(triaged, "gifs") // _GIFS_A_TASK))
    gifs = work.save(images.embed_gifs(_point_gifs(triaged, tasks), "id"))
    return work.save(triage.settle_gifs(triaged, gifs, current_points(spark, d)))


def settled_gifs(spark: SparkSession, d: str) -> DataFrame:
    """Every member of a cluster with its action, GIFs settled by decoding, hashing and embedding their frames."""
    return _settled(spark, d)


def _vector_gifs(spark: SparkSession, d: str) -> DataFrame:
    """(vec_id, content): an animation of one to seven frames for every vector, cut off where its label is 0."""

    @F.pandas_udf("binary")
    def content(point: pd.Series, label: pd.Series) -> pd.Series:
        made = [_animation(1, n) for n in range(1, 8)]
        return pd.Series([made[p % 7][: None if x else 60] for p, x in zip(point, label)])

    return _embeddings(spark, d).select("vec_id", content("vec_id", "label").alias("content"))


def gif_frame_counts(spark: SparkSession, d: str) -> DataFrame:
    """Frames and frame hashes of animations, and whether the data are broken."""
    rows = images.gif_frames(_vector_gifs(spark, d))
    return rows.select("vec_id", "n_frames", F.size(F.array_distinct("hashes")).alias("pictures"), F.col("error").isNotNull().alias("broken"))


def gif_status(spark: SparkSession, d: str) -> DataFrame:
    """How each animation is settled, and the length of its embedding."""
    rows = images.embed_gifs(_vector_gifs(spark, d), "vec_id")
    status = F.when(F.col("status").isin("ok", "same_frame"), F.col("status")).otherwise(F.lit("error"))
    return rows.select(F.col("id").alias("vec_id"), status.alias("status"), F.round(vectors.norm(F.col("embedding")), 3).alias("length"))


def image_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes of the perceptual hash of each vector drawn as a picture, and whether the picture at twice the brightness has the same."""
    tall = F.flatten(F.transform("embedding", lambda x: F.array_repeat(F.when(x > 0, 120).otherwise(40), 16)))
    rows = _embeddings(spark, d).select("vec_id", tall.alias("grey"))

    def pictures(times: int) -> DataFrame:
        @F.pandas_udf("binary")
        def data(values: pd.Series) -> pd.Series:
            return pd.Series([(np.asarray(v, np.uint8).reshape(8, 8, 4, 4).transpose(0, 2, 1, 3).reshape(32, 32) * times).astype(np.uint8).tobytes() for v in values])

        image = F.struct(F.lit(32).alias("height"), F.lit(32).alias("width"), F.lit(1).alias("nChannels"), data("grey").alias("data"))
        return images.image_hash(rows.select("vec_id", image.alias("image")), key="vec_id").select(F.col("key").alias("vec_id"), F.col("hash").alias(f"h{times}"))

    both = pictures(1).join(pictures(2), "vec_id")
    return both.select("vec_id", F.length("h1").alias("bytes"), (F.col("h1") == F.col("h2")).alias("same"))


def stored_points(spark: SparkSession, d: str) -> DataFrame:
    """A saved table of vectors opened again with metadata, extensions and URI prefixes: what it holds for each id."""
    path = Workspace(spark, "stored").root + "/points"
    rows = _embeddings(spark, d).select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vec"), "vec_id", "label")
    point_table.PointTable.builder(64).rows(rows, "vec_id").build(spark).save(path)
    ext = rows.where("label <> 2").select("id", F.lit("png").alias("ext"))
    table = point_table.PointTable.builder(64).path(path).metadata(rows.select("id", "label")).ext(ext).uri_prefix("web", "https://files.example.invalid/a/").build(spark)
    asked = rows.where("label < 5").select("id").unionByName(spark.createDataFrame([("nobody",)], "id string"))
    labels = point_table.must_match(table.rows.select("id", "idx"), table.metadata.withColumn("at", F.col("label")), "id", "at", "label")
    out = labels.join(table.uris("web"), "id").join(table.contains(asked), "id", "left")
    return out.select("id", "idx", "label", "uri", F.coalesce("found", F.lit(False)).alias("asked"))


def point_lookups(spark: SparkSession, d: str) -> DataFrame:
    """Single look-ups of a table: size, emptiness, index to id, id to index, first coordinate, similarity with itself."""
    rows = _embeddings(spark, d).select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("vec"), "vec_id")
    table = point_table.PointTable.builder(64).rows(rows, "vec_id").build(spark)
    first = table.index_to_id(0)
    held = (len(table), table.is_empty(), first, table.id_to_index(first), round(float(table.vector(first)[0]), 5), round(table.similarity(first, first), 6), table.id_to_index("nobody") is None, len(table.clear()))
    return spark.createDataFrame([held], "n bigint, empty boolean, first string, at bigint, x double, self double, unknown boolean, cleared bigint")


def index_search(spark: SparkSession, d: str) -> DataFrame:
    """A saved index, opened again, with the vectors of one label replaced: the three nearest of each vector of another."""
    path = Workspace(spark, "index").root + "/index"
    rows = _embeddings(spark, d)
    index = knn.KnnIndex.load_or_build(spark, path, lambda: rows.select("vec_id", "embedding"), key="vec_id", vec="embedding", metric="cosine")
    index = index.insert(rows.where("label = 1").select("vec_id", F.reverse("embedding").alias("embedding")))
    found = index.search_batch(rows.where("label = 3").select("vec_id", "embedding"), k=3)
    return found.select("query_id", "neighbor_id", "rank", F.round("distance", 6).alias("distance"))


def payload_updates(spark: SparkSession, d: str) -> DataFrame:
    """Points with the format and address of their corrected files put into their payload."""
    plan = payload_plan(spark, d)
    points = plan.select(F.col("point_id").alias("id")).distinct().withColumn("format", F.lit("unknown")).withColumn("url", F.lit(None).cast("string"))
    return extensions.update_payload(points, plan)


def optics_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """OPTICS over the set of all neighbours."""
    rows = _sign_hashes(spark, d)
    chosen = knn_neighbour_set(spark, d).withColumnRenamed("neighbor_id", "vec_id")
    return density.optics(rows.join(chosen, "vec_id", "left_semi"), "vec_id", "hash", eps=20, metric="hamming_bits")


def final_classification(spark: SparkSession, d: str) -> DataFrame:
    wide = triage.final_classification(_settled(spark, d))
    return wide.select("cluster_id", *(F.array_join(a, "|").alias(a) for a in (*triage.KEEP_ACTIONS, *triage.DISCARD_ACTIONS)))


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    return current_points(spark, d).select("id", F.when(F.col("categories").isNotNull(), tags.plain_tags(F.col("categories"))).alias("categories"))


def tag_transfer(spark: SparkSession, d: str) -> DataFrame:
    plan = triage.tag_transfer(_settled(spark, d), _tagged(spark, d))
    return plan.select("cluster_id", "id", "op", F.array_join("categories", "|").alias("categories"))


def points_after_transfer(spark: SparkSession, d: str) -> DataFrame:
    points = _tagged(spark, d)
    after = triage.apply_transfer(points, triage.tag_transfer(_settled(spark, d), points))
    return after.select("id", F.coalesce(F.array_join("categories", "|"), F.lit("")).alias("categories"))


def collection_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of the stored collections."""
    names = ("embeddings", "documents", "point_metadata", "object_listing")
    parts = [read_table(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in names]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def named_vector_scan(spark: SparkSession, d: str) -> DataFrame:
    """Points with a UUID id and a text vector."""
    rows = read_table(spark, d, "point_metadata").select("id", F.col("text_info.text_vector").alias("text_vector"))
    return point_table.scan_points(rows, "text_vector").groupBy("id").agg(F.count("*").alias("records"))


def members_without_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Cluster members with the size of their point, 0 where the point or its size is unknown."""
    points = current_points(spark, d).select("id", "size")
    return _members(spark, d).join(points, "id", "left").select("cluster_id", "id", F.coalesce("size", F.lit(0)).alias("size"))


def largest_member(spark: SparkSession, d: str) -> DataFrame:
    rows = members_without_metadata(spark, d)
    return rows.groupBy("cluster_id").agg(clusters.pick_largest(F.col("size"), F.col("id")).alias("id"))


def cluster_member_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = clusters.collect_members(_members(spark, d), "cluster_id", "id")
    n = F.size("members").cast("bigint")
    return rows.select("cluster_id", F.array_join("members", "|").alias("members"), clusters.pair_total(n).alias("pairs"))


def triage_counts(spark: SparkSession, d: str) -> DataFrame:
    return cluster_triage(spark, d).groupBy("action").agg(F.count("*").alias("n"))


def unit_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Length before, and first coordinate after normalisation."""
    rows = _embeddings(spark, d).select("vec_id", F.col("embedding").alias("v"))
    return rows.select("vec_id", F.round(vectors.norm(F.col("v")), 4).alias("length"), F.round(F.element_at(vectors.l2_normalize(F.col("v")), 1).cast("double"), 4).alias("x"))


def mean_vectors(spark: SparkSession, d: str) -> DataFrame:
    from siftwell.functions.images import mean_vector

    rows = mean_vector(_embeddings(spark, d), "label", "embedding")
    return rows.select("label", F.posexplode("embedding").alias("i", "x")).select("label", "i", F.round(F.col("x").cast("double"), 4).alias("x"))


def byte_distances(spark: SparkSession, d: str) -> DataFrame:
    """Unequal bytes, their share, and unequal bits of the hashes of each label's vectors."""
    rows = _embeddings(spark, d).select("vec_id", "label", vectors.sign_bytes(F.col("embedding"), 64).alias("h"))
    pairs = rows.alias("l").join(rows.alias("r"), (F.col("l.label") == F.col("r.label")) & (F.col("l.vec_id") < F.col("r.vec_id")))
    a, b = F.col("l.h"), F.col("r.h")
    return pairs.select(
        F.col("l.vec_id").alias("a"), F.col("r.vec_id").alias("b"), vectors.hamming_bytes(a, b).alias("bytes"),
        F.round(vectors.hamming_bytes(a, b, share=True), 6).alias("share"), vectors.hamming_bits(a, b).alias("bits"),
    )


def bytes_as_numbers(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "point_source").where("blob_head is not null").select("row_id", "blob_head").distinct()
    return rows.select("row_id", F.aggregate(vectors.bytes_to_floats(F.col("blob_head")), F.lit(0.0), lambda s, x: s + x).cast("bigint").alias("total"))


def parsed_stems(spark: SparkSession, d: str) -> DataFrame:
    """How many reference spellings are UUIDs, per column."""
    from siftwell.sources.files import parse_ids

    rows = read_table(spark, d, "search_result").select(paths.file_stem(F.col("uri")).alias("stem"))
    good, bad = parse_ids(rows, "stem")
    return good.agg(F.count("*").alias("n")).select(F.lit("id").alias("kind"), "n").union(bad.agg(F.count("*").alias("n")).select(F.lit("error").alias("kind"), "n"))


def chunk_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows per chunk of 20,000 by index."""
    chunk = F.floor(F.col("o_orderkey") / complete_link.CHUNK_ROWS).alias("chunk")
    return read_table(spark, d, "orders").groupBy(chunk).agg(F.count("*").alias("n"))


def ingest_names(spark: SparkSession, d: str) -> DataFrame:
    """Content-addressed targets of the blob heads."""
    files = _named_blobs(spark, d, ".jpg").withColumnRenamed("blob_head", "content")
    return extensions.ingest_plan(files, "/store").select("src", "dst", "action", "wrong_ext")


_NEAR = f"""near AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
  FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id)"""
_COMPONENTS = f"""
WITH RECURSIVE {_NEAR},
e AS (SELECT a, b FROM near WHERE similarity >= {EDGE} UNION SELECT b, a FROM near WHERE similarity >= {EDGE}),
walk AS (SELECT vec_id AS x, vec_id AS root FROM embeddings UNION SELECT e.b, walk.root FROM walk JOIN e ON e.a = walk.x WHERE walk.root < e.b)
SELECT x AS vec_id, min(root) AS cluster_id FROM walk GROUP BY x
"""


def _fold_sql(items: str, least: float) -> str:
    """Greedy complete-link over ``items`` (grp, key, vec): a list of labels grows by one record a step."""
    return f"""
t AS (SELECT grp, key, vec, row_number() OVER (PARTITION BY grp ORDER BY key) AS pos FROM ({items})),
sim AS (SELECT a.grp, a.pos, b.pos AS q FROM t a JOIN t b ON a.grp = b.grp AND b.pos < a.pos
        WHERE list_sum(list_transform(a.vec, lambda x: abs(x))) > 0 AND list_sum(list_transform(b.vec, lambda x: abs(x))) > 0
          AND list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]) > {least}),
hits AS (SELECT t.grp, t.pos, coalesce(list(sim.q) FILTER (WHERE sim.q IS NOT NULL), []) AS h FROM t LEFT JOIN sim ON t.grp = sim.grp AND t.pos = sim.pos GROUP BY 1, 2),
fold AS (
  SELECT grp, CAST(1 AS BIGINT) AS pos, [CAST(1 AS BIGINT)] AS lab FROM t WHERE pos = 1
  UNION ALL
  SELECT f.grp, f.pos + 1, list_append(f.lab, coalesce(
    list_min(list_filter(list_distinct(f.lab), lambda c: len(list_filter(generate_series(1, f.pos), lambda q: f.lab[q] = c AND NOT list_contains(n.h, q))) = 0)),
    list_max(f.lab) + 1))
  FROM fold f JOIN hits n ON n.grp = f.grp AND n.pos = f.pos + 1),
done AS (SELECT grp, arg_max(lab, pos) AS lab FROM fold GROUP BY grp),
part AS (SELECT t.grp, t.key, done.lab[t.pos] AS part FROM t JOIN done USING (grp))
"""


_MEMBERS = f"mem AS (SELECT DISTINCT cluster_id, {uuid_sql('id')} AS id FROM clusters WHERE cluster_id IS NOT NULL)"
_CURRENT = """cur AS (SELECT id, arg_max(struct_pack(height := height, width := width, weight := weight, size := size, categories := categories), (updated_at, idx)) AS r,
  first(text_info) FILTER (WHERE text_info IS NOT NULL) AS text_info FROM point_metadata WHERE id IS NOT NULL GROUP BY id)"""
_STEM = "regexp_extract({p}, '([^/]+?)([.][^./]*)?$', 1)"
_FILES = f"""files AS (SELECT point_id, arg_max(path, (taken_at, path)) AS path FROM (
  SELECT {_STEM.format(p='path')} AS point_id, path, taken_at FROM (SELECT {path_sql('path')} AS path, taken_at FROM object_listing
  WHERE mode = 'FILE' AND NOT coalesce(is_deleted, FALSE) AND path IS NOT NULL)) GROUP BY 1)"""
_TRIAGE = f"""
WITH RECURSIVE {_MEMBERS}, {_CURRENT}, {_FILES},
rows AS (SELECT mem.cluster_id, mem.id, coalesce(cur.r.size, 0) AS size, list_last(string_split(files.path, '.')) AS ext,
           CASE WHEN len(cur.text_info.text_vector) = 64 THEN cur.text_info.text_vector END AS vec
         FROM mem LEFT JOIN cur ON cur.id = mem.id LEFT JOIN files ON files.point_id = mem.id AND cur.id IS NOT NULL),
{_fold_sql('SELECT cluster_id AS grp, id AS key, vec FROM rows WHERE vec IS NOT NULL', 0.9)},
kept AS (SELECT p.grp AS cluster_id, arg_max(r.id, (r.size, r.id)) AS id FROM part p JOIN rows r ON r.cluster_id = p.grp AND r.id = p.key GROUP BY p.grp, p.part),
marked AS (SELECT rows.*, kept.id IS NOT NULL AS kept FROM rows LEFT JOIN kept USING (cluster_id, id)),
facts AS (SELECT cluster_id, bool_and(vec IS NOT NULL) AS all_text, bool_or(NOT kept AND coalesce(ext = 'gif', FALSE)) AS has_gif,
            arg_max(id, (size, id)) FILTER (WHERE NOT kept) AS largest FROM marked GROUP BY 1),
triaged AS (SELECT m.cluster_id, m.id, CASE WHEN kept THEN 'kept_text' WHEN all_text THEN 'other_delete'
      WHEN has_gif THEN CASE WHEN ext = 'gif' THEN 'gif_triage' ELSE 'other_delete' END
      WHEN m.id = largest THEN 'kept_non_gif' ELSE 'other_delete' END AS action
    FROM marked m JOIN facts USING (cluster_id)),
moving AS (SELECT t.cluster_id, t.id, substr(t.id, 1, 1) IN ('8', '9', 'a', 'b') AS stripes, r.size FROM triaged t JOIN rows r USING (cluster_id, id)
           WHERE action = 'gif_triage' AND substr(t.id, 1, 1) >= '8'),
chosen AS (SELECT cluster_id, arg_max(id, (size, id)) AS id FROM moving GROUP BY cluster_id, stripes),
settled AS (SELECT t.cluster_id, t.id, CASE WHEN action <> 'gif_triage' THEN action WHEN substr(t.id, 1, 1) < '4' THEN 'invalid_gif'
    WHEN substr(t.id, 1, 1) < '8' THEN 'same_frame_gif' WHEN chosen.id IS NOT NULL THEN 'kept_gif' ELSE 'duplicate_gif' END AS action
  FROM triaged t LEFT JOIN chosen ON chosen.cluster_id = t.cluster_id AND chosen.id = t.id)
"""
_PLAIN_TAGS = "list_sort(list_distinct(list_filter(list_transform({c}, lambda t: trim(regexp_replace(lower(t), '[\\s_\\-]+', ' ', 'g'))), lambda t: t <> '')))"
_TRANSFER = f"""{_TRIAGE},
own AS (SELECT s.*, action LIKE 'kept%' AS keep, {_PLAIN_TAGS.format(c='cur.r.categories')} AS tags FROM settled s LEFT JOIN cur USING (id)),
given AS (SELECT cluster_id, list(DISTINCT tag) AS given FROM (SELECT cluster_id, unnest(tags) AS tag FROM own WHERE NOT keep) GROUP BY 1),
plan AS (SELECT own.cluster_id, own.id, CASE WHEN keep THEN 'upsert' ELSE 'delete' END AS op,
           CASE WHEN keep THEN list_sort(list_distinct(list_concat(coalesce(tags, []), coalesce(given, [])))) END AS tags
         FROM own LEFT JOIN given USING (cluster_id))
"""
_LISTS = ", ".join(f"string_agg(id, '|' ORDER BY id) FILTER (WHERE action = '{a}') AS {a}" for a in (*triage.KEEP_ACTIONS, *triage.DISCARD_ACTIONS))
_SIGNS = "signs AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS s FROM embeddings)"
_BITS = "len(list_filter(generate_series(1, 64), lambda i: a.s[i] <> b.s[i]))"
_BYTES = "len(list_filter(generate_series(0, 7), lambda k: a.s[k * 8 + 1:k * 8 + 8] <> b.s[k * 8 + 1:k * 8 + 8])) / 8.0"
_MAGIC = """CASE WHEN h LIKE 'FFD8FF%' THEN 'jpg' WHEN h LIKE '89504E470D0A1A0A%' THEN 'png' WHEN h LIKE '474946383761%' OR h LIKE '474946383961%' THEN 'gif'
  WHEN substr(h, 17, 8) = '57454250' THEN 'webp' WHEN h LIKE '49492A00%' OR h LIKE '4D4D002A%' THEN 'tif' WHEN h LIKE '424D%' THEN 'bmp' WHEN h LIKE '25504446%' THEN 'pdf' END"""
_VERDICTS = f"""WITH b AS (SELECT DISTINCT {uuid_sql('id')} AS id, blob_head FROM point_source WHERE kind = 'blob'),
found AS (SELECT id || '.{{ext}}' AS path, {_MAGIC} AS found, '{{own}}' AS own FROM (SELECT id, upper(hex(blob_head)) AS h FROM b))
SELECT path, CASE WHEN found IS NULL THEN 'failed' WHEN found = own THEN 'ok' ELSE 'wrong' END AS status,
  CASE WHEN found <> own THEN found END AS expected_ext, CASE WHEN found IS NULL THEN 'unknown type' END AS error FROM found"""
_WRONG = f"wrong AS (SELECT DISTINCT {path_sql('path')} AS path, expected_ext FROM wrong_ext)"
_UUID5 = "sha1(unhex('4f20175332b85108aa76d2e8c65310f4') || encode(sha1(text)))"

_DBSCAN = f"""
WITH RECURSIVE {_NEAR},
e AS (SELECT a, b FROM near WHERE similarity >= {1 - REACH} UNION ALL SELECT b, a FROM near WHERE similarity >= {1 - REACH}),
core AS (SELECT vec_id AS x FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY a) d ON d.a = vec_id WHERE coalesce(n, 0) + 1 >= 3),
ce AS (SELECT a, b FROM e SEMI JOIN core p ON e.a = p.x SEMI JOIN core q ON e.b = q.x),
walk AS (SELECT x, x AS root FROM core UNION SELECT ce.b, walk.root FROM walk JOIN ce ON ce.a = walk.x WHERE walk.root < ce.b),
lab AS (SELECT x, min(root) AS cluster_id FROM walk GROUP BY x),
reach AS (SELECT e.a AS x, min(cluster_id) AS near FROM e JOIN lab ON lab.x = e.b GROUP BY 1)
SELECT vec_id, coalesce(lab.cluster_id, reach.near) AS cluster_id,
  CASE WHEN lab.x IS NOT NULL THEN 'core' WHEN reach.x IS NOT NULL THEN 'border' ELSE 'noise' END AS role
FROM embeddings LEFT JOIN lab ON lab.x = vec_id LEFT JOIN reach ON reach.x = vec_id
"""

_CHUNKED = f"""
WITH RECURSIVE {_fold_sql('SELECT vec_id // 100 AS grp, vec_id AS key, embedding AS vec FROM embeddings', LINK)},
cl AS (SELECT grp, part, row_number() OVER (ORDER BY grp, part) AS pos, count(*) AS n FROM part GROUP BY grp, part),
m AS (SELECT cl.pos, cl.n, p.key, e.embedding AS vec FROM part p JOIN cl USING (grp, part) JOIN embeddings e ON e.vec_id = p.key),
alike AS (SELECT a.pos, b.pos AS q FROM m a JOIN m b ON b.pos < a.pos
          WHERE list_cosine_similarity(a.vec::DOUBLE[], b.vec::DOUBLE[]) > {LINK} GROUP BY a.pos, b.pos, a.n, b.n HAVING count(*) = a.n * b.n),
near2 AS (SELECT cl.pos, coalesce(list(q) FILTER (WHERE q IS NOT NULL), []) AS h FROM cl LEFT JOIN alike USING (pos) GROUP BY 1),
merge AS (
  SELECT CAST(1 AS BIGINT) AS pos, [CAST(1 AS BIGINT)] AS lab
  UNION ALL
  SELECT f.pos + 1, list_append(f.lab, coalesce(
    list_min(list_filter(list_distinct(f.lab), lambda c: len(list_filter(generate_series(1, f.pos), lambda q: f.lab[q] = c AND NOT list_contains(n.h, q))) = 0)),
    list_max(f.lab) + 1))
  FROM merge f JOIN near2 n ON n.pos = f.pos + 1),
whole AS (SELECT arg_max(lab, pos) AS lab FROM merge)
SELECT key AS vec_id, min(key) OVER (PARTITION BY whole.lab[m.pos]) AS cluster_id FROM m, whole
"""

QUERIES = {
    f.__name__: f
    for f in (
        near_dup_components, near_dup_pairs, component_sizes, complete_link_clusters, chunked_complete_link, dbscan, hdbscan, hamming_knn,
        knn_neighbour_set, query_knn, optics_sample, pacmap_embedding, sample_plus_seeds, pairwise_graph, cluster_size_stats,
        cluster_size_histogram, largest_clusters, order_statistics, largest_line_per_order, top_lines_per_supplier, fetch_by_ids,
        ids_without_match, distinct_pairs, content_ids, exact_duplicate_groups, ext_verdicts, ext_verdicts_local, detected_types,
        filtered_paths, rename_plan, payload_plan, uri_for_points, payload_projection, frame_sampling, vector_store_changes,
        collection_counts, named_vector_scan, members_without_metadata, largest_member, cluster_member_lists, triage_counts,
        unit_vectors, mean_vectors, byte_distances, bytes_as_numbers, parsed_stems, chunk_sizes, ingest_names,
        point_metadata, cluster_triage, final_classification, tag_transfer, points_after_transfer, settled_gifs, gif_frame_counts,
        gif_status, image_hashes, stored_points, point_lookups, index_search, payload_updates, optics_neighbours,
    )
}
ORACLES = {
    "near_dup_components": _COMPONENTS,
    "near_dup_pairs": f"WITH {_NEAR} SELECT a, b, round(similarity, 6) AS similarity FROM near WHERE similarity >= {EDGE}",
    "component_sizes": f"SELECT cluster_id, count(*) AS size FROM ({_COMPONENTS}) GROUP BY 1",
    "complete_link_clusters": f"WITH RECURSIVE {_fold_sql('SELECT label AS grp, vec_id AS key, embedding AS vec FROM embeddings', LINK)} SELECT key AS vec_id, min(key) OVER (PARTITION BY grp, part) AS cluster_id FROM part",
    "chunked_complete_link": _CHUNKED,
    "dbscan": _DBSCAN,
    "hamming_knn": f"WITH {_SIGNS}, d AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, {_BITS} AS distance FROM signs a JOIN signs b ON a.vec_id <> b.vec_id) "
    "SELECT query_id, neighbor_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank, distance FROM d QUALIFY rank <= 20",
    "knn_neighbour_set": f"WITH {_SIGNS}, d AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, {_BYTES} AS distance FROM signs a JOIN signs b ON a.vec_id <> b.vec_id), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d) SELECT DISTINCT neighbor_id FROM r WHERE rank <= 200 AND distance <= 0.75",
    "query_knn": "WITH d AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, 1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.label = 3) "
    "SELECT query_id, neighbor_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank, round(distance, 6) AS distance FROM d QUALIFY rank <= 10",
    "sample_plus_seeds": "SELECT vec_id, TRUE AS is_seed FROM embeddings WHERE label = 3 UNION ALL "
    "(SELECT vec_id, FALSE FROM embeddings WHERE label <> 3 ORDER BY md5('7/' || vec_id), vec_id LIMIT 200)",
    "pairwise_graph": f"WITH {_NEAR}, l AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i, count(*) OVER () AS n FROM embeddings WHERE label = 3), "
    "p AS (SELECT vec_id, round(500 + 400 * cos(2 * pi() * i / n))::BIGINT AS x, round(500 + 400 * sin(2 * pi() * i / n))::BIGINT AS y FROM l) "
    f"SELECT a, b, round(similarity, 6) AS similarity, similarity < {EDGE} AS low, pa.x AS a_x, pa.y AS a_y, pb.x AS b_x, pb.y AS b_y FROM near JOIN p pa ON pa.vec_id = a JOIN p pb ON pb.vec_id = b",
    "cluster_size_stats": "WITH s AS (SELECT count(*) AS size FROM clusters GROUP BY cluster_id HAVING count(*) > 1), m AS (SELECT size FROM s GROUP BY size ORDER BY count(*) DESC, size LIMIT 1) "
    "SELECT count(*) AS n, min(size) AS min, max(size) AS max, round(avg(size), 6) AS mean, median(size) AS median, (SELECT size FROM m) AS mode FROM s",
    "cluster_size_histogram": "SELECT size, count(*) AS n FROM (SELECT count(*) AS size FROM clusters GROUP BY cluster_id HAVING count(*) > 1) GROUP BY 1",
    "largest_clusters": f"WITH {_MEMBERS} SELECT cluster_id, count(*) AS size, list_sort(list(id))[1:5] AS preview FROM mem GROUP BY 1",
    "order_statistics": "WITH s AS (SELECT count(*) AS size FROM lineitem GROUP BY l_orderkey), m AS (SELECT size FROM s GROUP BY size ORDER BY count(*) DESC, size LIMIT 1) "
    "SELECT count(*) AS n, min(size) AS min, max(size) AS max, round(avg(size), 6) AS mean, median(size) AS median, (SELECT size FROM m) AS mode FROM s",
    "largest_line_per_order": "SELECT l_orderkey, arg_max(l_linenumber, (coalesce(l_quantity, 0), l_linenumber)) AS l_linenumber FROM lineitem GROUP BY 1",
    "top_lines_per_supplier": "SELECT l_suppkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem QUALIFY rank <= 5",
    "fetch_by_ids": "SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
    "ids_without_match": "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "distinct_pairs": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "content_ids": f"SELECT doc_id, concat_ws('-', h[1:8], h[9:12], '5' || h[14:16], substr('89ab', (instr('0123456789abcdef', h[17:17]) - 1) % 4 + 1, 1) || h[18:20], h[21:32]) AS content_id FROM (SELECT doc_id, {_UUID5} AS h FROM documents WHERE text IS NOT NULL)",
    "exact_duplicate_groups": f"SELECT any_value(concat_ws('-', h[1:8], h[9:12], '5' || h[14:16], substr('89ab', (instr('0123456789abcdef', h[17:17]) - 1) % 4 + 1, 1) || h[18:20], h[21:32])) AS content_id, count(*) AS n, min(doc_id) AS first_doc FROM (SELECT doc_id, {_UUID5} AS h FROM documents) GROUP BY h HAVING count(*) > 1",
    "ext_verdicts": _VERDICTS.replace("{ext}", "jpg").replace("{own}", "jpg"),
    "ext_verdicts_local": _VERDICTS.replace("{ext}", "GIF").replace("{own}", "gif"),
    "detected_types": f"SELECT {_MAGIC} AS ext, count(*) AS n FROM (SELECT upper(hex(blob_head)) AS h FROM point_source WHERE blob_head IS NOT NULL) GROUP BY 1",
    "filtered_paths": f"SELECT DISTINCT row_id, path FROM (SELECT row_id, {path_sql('path')} AS path FROM wrong_ext) WHERE (contains(path, '/raw/') OR contains(path, 'album')) AND NOT contains(path, '.gif')",
    "rename_plan": f"WITH {_WRONG} SELECT path AS src, string_split(path, '.')[1] || '.' || expected_ext AS dst FROM wrong WHERE (list_last(string_split(path, '.')), expected_ext) IN (('jpg', 'png'), ('png', 'jpg'))",
    "payload_plan": f"WITH {_WRONG}, s AS (SELECT *, {_STEM.format(p='path')} AS point_id FROM wrong WHERE path IS NOT NULL AND expected_ext IS NOT NULL) "
    "SELECT point_id, path AS src, point_id || '.' || expected_ext AS dst, expected_ext AS target_ext, expected_ext AS format, 'https://files.example.invalid/' || point_id || '.' || expected_ext AS url FROM s WHERE point_id <> ''",
    "payload_updates": f"WITH {_WRONG}, s AS (SELECT *, {_STEM.format(p='path')} AS point_id FROM wrong WHERE path IS NOT NULL AND expected_ext IS NOT NULL) "
    "SELECT point_id AS id, arg_max(expected_ext, (path, expected_ext)) AS format, arg_max('https://files.example.invalid/' || point_id || '.' || expected_ext, (path, expected_ext)) AS url FROM s WHERE point_id <> '' GROUP BY 1",
    "uri_for_points": f"WITH o AS (SELECT DISTINCT prefix_key, {path_sql('path')} AS path FROM object_listing WHERE mode = 'FILE' AND path IS NOT NULL), "
    f"n AS (SELECT path, prefix, list_last(string_split(path, '/')) AS name FROM o LEFT JOIN uri_prefixes USING (prefix_key)) "
    "SELECT path, CASE WHEN regexp_matches(prefix, '^[A-Za-z][A-Za-z0-9+.-]+:') THEN 'url' ELSE 'path' END AS kind, "
    "CASE WHEN regexp_matches(prefix, '^[A-Za-z][A-Za-z0-9+.-]+:') THEN regexp_replace(prefix, '[^/]*$', '') || name "
    "WHEN prefix[-1:] IN ('/', chr(92)) THEN prefix || name ELSE prefix || CASE WHEN contains(prefix, chr(92)) THEN chr(92) ELSE '/' END || name END AS uri FROM n",
    "payload_projection": "SELECT event_id, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS point_id, k FROM (SELECT event_id, lpad(lower(to_hex(event_id)), 32, '0') AS h, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)",
    "frame_sampling": "SELECT l_orderkey, l_linenumber, CASE WHEN n < 5 THEN range(0, n) ELSE list_sort(list_distinct([0, n // 4, n * 2 // 4, n * 3 // 4, n - 1])) END AS frames FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS n FROM lineitem)",
    "vector_store_changes": "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS idx, CAST(vec_id AS VARCHAR) AS id, round(CAST(CASE WHEN label = 1 THEN embedding[64] ELSE embedding[1] END AS DOUBLE), 6) AS x FROM embeddings WHERE label <> 2",
    "point_metadata": f"WITH {_CURRENT} SELECT id, r.height AS height, coalesce(r.width, r.weight) AS width, r.size AS size, coalesce(list_aggregate({_PLAIN_TAGS.format(c='r.categories')}, 'string_agg', '|'), '') AS categories, text_info IS NOT NULL AS has_text FROM cur",
    "collection_counts": "SELECT 'embeddings' AS name, count(*) AS n FROM embeddings UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'point_metadata', count(*) FROM point_metadata UNION ALL SELECT 'object_listing', count(*) FROM object_listing",
    "named_vector_scan": "SELECT id, count(*) AS records FROM point_metadata WHERE regexp_full_match(id, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}') AND text_info.text_vector IS NOT NULL GROUP BY 1",
    "members_without_metadata": f"WITH {_MEMBERS}, {_CURRENT} SELECT cluster_id, mem.id, coalesce(cur.r.size, 0) AS size FROM mem LEFT JOIN cur USING (id)",
    "largest_member": f"WITH {_MEMBERS}, {_CURRENT} SELECT cluster_id, arg_max(mem.id, (coalesce(cur.r.size, 0), mem.id)) AS id FROM mem LEFT JOIN cur USING (id) GROUP BY 1",
    "cluster_member_lists": f"WITH {_MEMBERS} SELECT cluster_id, string_agg(id, '|' ORDER BY id) AS members, count(*) * (count(*) - 1) // 2 AS pairs FROM mem GROUP BY 1",
    "triage_counts": f"{_TRIAGE} SELECT action, count(*) AS n FROM triaged GROUP BY 1",
    "unit_vectors": "WITH l AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings) SELECT vec_id, round(n, 4) AS length, CASE WHEN n > 0 THEN round(v[1] / n, 4) END AS x FROM l",
    "mean_vectors": "WITH m AS (SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, unnest(range(0, 64)) AS i FROM embeddings) GROUP BY 1, 2) "
    "SELECT label, i, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 4) AS x FROM m",
    "byte_distances": f"WITH s AS (SELECT vec_id, label, list_transform(embedding, lambda x: x > 0) AS s FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, {_BYTES} AS share, {_BITS} AS bits FROM s a JOIN s b ON a.label = b.label AND a.vec_id < b.vec_id) "
    "SELECT a, b, CAST(share * 8 AS INTEGER) AS bytes, round(share, 6) AS share, bits FROM p",
    "bytes_as_numbers": "SELECT row_id, list_sum(list_transform(range(0, octet_length(blob_head)), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)) AS total FROM (SELECT DISTINCT row_id, blob_head, hex(blob_head) AS h FROM point_source WHERE blob_head IS NOT NULL)",
    "parsed_stems": f"WITH s AS (SELECT {uuid_sql(_STEM.format(p='uri').replace('[^/]+?', '[^/' + chr(92) * 2 + ']+?').replace('[^./]*', '[^./' + chr(92) * 2 + ']*'))} AS id FROM search_result) "
    "SELECT CASE WHEN coalesce(regexp_full_match(id, '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}'), FALSE) THEN 'id' ELSE 'error' END AS kind, count(*) AS n FROM s GROUP BY 1",
    "chunk_sizes": "SELECT o_orderkey // 20000 AS chunk, count(*) AS n FROM orders GROUP BY 1",
    "ingest_names": f"""WITH b AS (SELECT DISTINCT {uuid_sql('id')} AS id, blob_head FROM point_source WHERE kind = 'blob'),
f AS (SELECT id, {_MAGIC.replace('h LIKE', 'hx LIKE').replace('substr(h,', 'substr(hx,')} AS found, sha1(unhex('4f20175332b85108aa76d2e8c65310f4') || encode(sha1(blob_head))) AS h FROM (SELECT *, upper(hex(blob_head)) AS hx FROM b))
SELECT id || '.jpg' AS src, '/store/' || concat_ws('-', h[1:8], h[9:12], '5' || h[14:16], substr('89ab', (instr('0123456789abcdef', h[17:17]) - 1) % 4 + 1, 1) || h[18:20], h[21:32]) || '.' || coalesce(found, 'jpg') AS dst,
  CASE WHEN found IS NULL THEN 'failed' ELSE 'copy' END AS action, CASE WHEN found <> 'jpg' THEN found END AS wrong_ext FROM f""",
    "cluster_triage": f"{_TRIAGE} SELECT cluster_id, id, action FROM triaged",
    "settled_gifs": f"{_TRIAGE} SELECT cluster_id, id, action FROM settled",
    "gif_frame_counts": "SELECT vec_id, CASE WHEN label <> 0 THEN (1 + vec_id % 7)::INTEGER END AS n_frames, CASE WHEN label <> 0 THEN least(1 + vec_id % 7, 4)::INTEGER END AS pictures, label = 0 AS broken FROM embeddings",
    "gif_status": "SELECT vec_id, CASE WHEN label = 0 THEN 'error' WHEN vec_id % 7 = 0 THEN 'same_frame' ELSE 'ok' END AS status, CASE WHEN label <> 0 AND vec_id % 7 > 0 THEN 1.0::DOUBLE END AS length FROM embeddings",
    "image_hashes": "SELECT vec_id, 32 AS bytes, TRUE AS same FROM embeddings",
    "stored_points": "SELECT CAST(vec_id AS VARCHAR) AS id, row_number() OVER (ORDER BY vec_id) - 1 AS idx, label, CASE WHEN label <> 2 THEN 'https://files.example.invalid/a/' || vec_id || '.png' END AS uri, label < 5 AS asked FROM embeddings",
    "point_lookups": "SELECT count(*) AS n, FALSE AS empty, CAST(min(vec_id) AS VARCHAR) AS first, 0::BIGINT AS at, round(arg_min(embedding[1]::DOUBLE, vec_id), 5) AS x, 1.0::DOUBLE AS self, TRUE AS unknown, 0::BIGINT AS cleared FROM embeddings",
    "index_search": "WITH p AS (SELECT vec_id, CASE WHEN label = 1 THEN list_reverse(embedding) ELSE embedding END AS v FROM embeddings), d AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, 1 - list_cosine_similarity(a.embedding::DOUBLE[], b.v::DOUBLE[]) AS distance FROM embeddings a JOIN p b ON a.vec_id <> b.vec_id WHERE a.label = 3) "
    "SELECT query_id, neighbor_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank, round(distance, 6) AS distance FROM d QUALIFY rank <= 3",
    "final_classification": f"{_TRIAGE} SELECT cluster_id, {_LISTS} FROM settled GROUP BY 1",
    "tag_transfer": f"{_TRANSFER} SELECT cluster_id, id, op, CASE WHEN tags IS NOT NULL THEN coalesce(list_aggregate(tags, 'string_agg', '|'), '') END AS categories FROM plan",
    "points_after_transfer": f"""{_TRANSFER},
ups AS (SELECT id, list_sort(list(DISTINCT tag) FILTER (WHERE tag IS NOT NULL)) AS tags FROM (SELECT id, unnest(CASE WHEN len(tags) = 0 THEN [NULL] ELSE tags END) AS tag FROM plan WHERE op = 'upsert') GROUP BY 1),
gone AS (SELECT DISTINCT id FROM plan WHERE op = 'delete' AND id NOT IN (SELECT id FROM ups))
SELECT cur.id, coalesce(list_aggregate(CASE WHEN ups.id IS NOT NULL THEN ups.tags ELSE {_PLAIN_TAGS.format(c='cur.r.categories')} END, 'string_agg', '|'), '') AS categories
FROM cur LEFT JOIN ups USING (id) WHERE cur.id NOT IN (SELECT id FROM gone)""",
}
