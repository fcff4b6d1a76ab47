"""Named queries of the training-data operators and, where SQL can express them, their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions.ids import canonical_uuid
from siftwell.functions.paths import file_stem
from siftwell.llm import cooccurrence, history, languages, leakage, matches, neighbours, packing, survivors
from siftwell.plans.sql import tag_sql, uuid_sql
from siftwell.runtime import Workspace, read_table

#: Largest distance of a match (20 of 32 hash bytes).
MATCH_DISTANCE = 0.625


def _point_numbers(points: DataFrame, work: Workspace) -> DataFrame:
    """(id, n): numbers of all points in the order of their ids."""
    ids = points.select(canonical_uuid("id").alias("id")).where("id is not null").distinct()
    return work.save(ids.orderBy("id").withColumn("n", F.monotonically_increasing_id()))


def matched_points(results: DataFrame, numbers: DataFrame) -> DataFrame:
    """(a, b) numbers of the two points of each match; ids of no point are left out."""
    near = results.where((F.col("distance") >= 0) & (F.col("distance") <= MATCH_DISTANCE))
    other = F.coalesce(canonical_uuid("neighbor_id"), canonical_uuid(file_stem(F.col("uri"))))
    named = near.select(canonical_uuid("query_id").alias("q"), other.alias("r")).where("q <> r")
    as_a, as_b = (numbers.select(F.col("id").alias(c), F.col("n").alias(k)) for c, k in (("q", "a"), ("r", "b")))
    return named.distinct().join(as_a, "q").join(as_b, "r").select("a", "b")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.point_neighbours(read_table(spark, d, "point_metadata"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return history.repeats_of_tables(read_table(spark, d, "point_metadata"), read_table(spark, d, "wrong_ext"))


def p4_batches(spark: SparkSession, d: str) -> DataFrame:
    """The rows of p4_found from stored histories that take one delivered batch after the other."""
    folder = Workspace(spark, "stored").root
    return history.repeats_by_batch(read_table(spark, d, "point_metadata"), read_table(spark, d, "wrong_ext"), folder)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    work = Workspace(spark, "points")
    numbers = _point_numbers(read_table(spark, d, "point_metadata"), work)
    grouped = matches.match_groups(matched_points(read_table(spark, d, "search_result"), numbers))
    names = numbers.withColumnRenamed("n", "m")
    member = grouped.withColumnRenamed("id", "m").join(names, "m").select("group_id", "id")
    label = numbers.select(F.col("n").alias("group_id"), F.col("id").alias("label"))
    return member.join(label, "group_id").select(F.col("label").alias("group_id"), "id")


def p5_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Number of groups of each size."""
    sizes = p5_found(spark, d).groupBy("group_id").agg(F.count("*").alias("members"))
    return sizes.groupBy("members").agg(F.count("*").alias("n"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    stats = cooccurrence.point_tag_pairs(read_table(spark, d, "point_metadata"))
    return cooccurrence.frequent_pairs(stats).select("tag_a", "tag_b")


def p6_pair_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts, lift and conviction of every pair of tags."""
    return cooccurrence.point_tag_pairs(read_table(spark, d, "point_metadata"))


def _survivors(spark: SparkSession, d: str, use_times: bool) -> DataFrame:
    tables = (read_table(spark, d, t) for t in ("clusters", "point_metadata", "writers"))
    return survivors.cluster_survivors(*tables, use_times=use_times)


def p7_method(spark: SparkSession, d: str) -> DataFrame:
    """Survivors with every member's time taken as missing, so that learned precedence decides."""
    return _survivors(spark, d, use_times=False)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _survivors(spark, d, use_times=True)


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, d, "documents"), read_table(spark, d, "pack_specs"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, least possible containers and unused share per capacity."""
    return packing.fill_report(p8_packing(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_passages(spark, d).select("doc_id", "item_id").distinct()


def p9_passages(spark: SparkSession, d: str) -> DataFrame:
    """Longest run of words of each leaked item and its place in the original text."""
    return leakage.leaked_items(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    documents = read_table(spark, d, "documents")
    return languages.mislabelled(languages.document_languages(documents, languages.fit_on_documents(documents)))


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    """Languages in each text with a confidence, next to those its label names."""
    documents = read_table(spark, d, "documents")
    return languages.document_languages(documents, languages.fit_on_documents(documents))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment with its place, language and confidence."""
    documents = read_table(spark, d, "documents")
    return languages.language_segments(documents, languages.fit_on_documents(documents))


_POINT_IDS = f"ids AS (SELECT DISTINCT {uuid_sql('id')} AS id FROM point_metadata WHERE id IS NOT NULL)"
_P5 = f"""
WITH RECURSIVE {_POINT_IDS},
near AS (SELECT {uuid_sql('query_id')} AS q,
                coalesce({uuid_sql('neighbor_id')}, {uuid_sql("regexp_extract(uri, '([^/' || chr(92) || chr(92) || ']+?)([.][^./' || chr(92) || chr(92) || ']*)?$', 1)")}) AS r
         FROM search_result WHERE distance >= 0 AND distance <= 0.625 AND NOT isnan(distance)),
e AS (SELECT DISTINCT q, r FROM near SEMI JOIN ids a ON q = a.id SEMI JOIN ids b ON r = b.id WHERE q <> r),
s AS (SELECT q, r FROM e UNION SELECT r, q FROM e),
walk AS (SELECT q AS id, q AS root FROM s UNION SELECT s.r, walk.root FROM walk JOIN s ON s.q = walk.id WHERE walk.root < s.r)
SELECT min(root) AS group_id, id FROM walk GROUP BY id
"""
_CURRENT = "cur AS (SELECT id, arg_max(struct_pack(height := height, width := width, weight := weight, size := size, categories := categories, writer := writer, updated_at := updated_at), (updated_at, idx)) AS r FROM point_metadata WHERE id IS NOT NULL GROUP BY id)"
_P6_STATS = f"""
WITH {_CURRENT},
bag AS (SELECT id, list_distinct(list_filter(list_transform(coalesce(r.categories, []), lambda t: {tag_sql('t')}), lambda t: t <> '')) AS tags FROM cur),
one AS (SELECT id, unnest(tags) AS tag FROM bag),
n AS (SELECT count(DISTINCT id) AS n FROM one),
k AS (SELECT tag, count(*) AS k FROM one GROUP BY 1),
p AS (SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n_ab FROM one a JOIN one b ON a.id = b.id AND a.tag < b.tag GROUP BY 1, 2)
SELECT tag_a, tag_b, n_ab, ka.k AS n_a, kb.k AS n_b, n.n AS n,
  round(n_ab * n.n / (ka.k * kb.k), 6) AS lift,
  CASE WHEN ka.k > n_ab THEN round(ka.k * (1 - kb.k / n.n) / (ka.k - n_ab), 6) END AS conviction
FROM p JOIN k ka ON ka.tag = tag_a JOIN k kb ON kb.tag = tag_b, n
"""
_P7 = f"""
WITH {_CURRENT},
mem AS (SELECT DISTINCT cluster_id, {uuid_sql('id')} AS id FROM clusters WHERE cluster_id IS NOT NULL),
m AS (SELECT cluster_id, cur.id, coalesce(trust, 0) AS trust, r.updated_at AS ts, r.categories AS categories,
        CASE WHEN r.height > 0 THEN r.height END AS height, CASE WHEN r.size > 0 THEN r.size END AS size,
        coalesce(CASE WHEN r.width > 0 THEN r.width END, CASE WHEN r.weight > 0 THEN r.weight END) AS width
      FROM mem JOIN cur ON mem.id = {uuid_sql('cur.id')} LEFT JOIN writers w ON w.writer = r.writer),
tags AS (SELECT cluster_id, string_agg(DISTINCT tag, '|' ORDER BY tag) AS categories
         FROM (SELECT cluster_id, {tag_sql('t')} AS tag FROM (SELECT cluster_id, unnest(categories) AS t FROM m)) WHERE tag <> '' GROUP BY 1)
SELECT m.cluster_id, arg_max(m.id, (coalesce(m.size, 0), m.id)) AS keep_id,
  coalesce(arg_max(height, (trust, ts, m.id)) FILTER (WHERE height IS NOT NULL), -1) AS height,
  coalesce(arg_max(width, (trust, ts, m.id)) FILTER (WHERE width IS NOT NULL), -1) AS width,
  coalesce(arg_max(m.size, (trust, ts, m.id)) FILTER (WHERE m.size IS NOT NULL), -1) AS size,
  coalesce(any_value(tags.categories), '') AS categories
FROM m LEFT JOIN tags USING (cluster_id) GROUP BY m.cluster_id
"""

QUERIES = {
    "p2_found": p2_found,
    "p4_found": p4_found,
    "p4_batches": p4_batches,
    "p5_found": p5_found,
    "p5_sizes": p5_sizes,
    "p6_found": p6_found,
    "p6_pair_counts": p6_pair_counts,
    "p7_method": p7_method,
    "p7_found": p7_found,
    "p8_packing": p8_packing,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p10_found": p10_found,
    "p10_documents": p10_documents,
    "p10_segments": p10_segments,
}
ORACLES = {
    "p5_found": _P5,
    "p5_sizes": f"SELECT members, count(*) AS n FROM (SELECT group_id, count(*) AS members FROM ({_P5}) GROUP BY 1) GROUP BY 1",
    "p6_found": f"SELECT tag_a, tag_b FROM ({_P6_STATS}) WHERE n_ab >= 3 AND n_ab * n >= 3 * n_a * n_b",
    "p6_pair_counts": _P6_STATS,
    "p7_found": _P7,
}
