"""Queries on missing references and snapshot changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators import references as refs
from siftwell.operators import snapshots
from siftwell.plans.sql import PRESENT_OBJECTS, path_sql, uuid_sql
from siftwell.runtime import read_table


def _all_references(spark: SparkSession, d: str) -> DataFrame:
    return refs.collect_references(
        *(read_table(spark, d, t) for t in ("point_source", "clusters", "search_result", "wrong_ext"))
    )


def _timelines(spark: SparkSession, d: str) -> DataFrame:
    return refs.point_timeline(read_table(spark, d, "point_metadata")).unionByName(
        refs.object_timeline(read_table(spark, d, "object_listing"))
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return refs.orphan_references(_all_references(spark, d), _timelines(spark, d))


def p1_method(spark: SparkSession, d: str) -> DataFrame:
    """Orphan keys of the ledger after each month's deltas, and the references to them, per table and column."""
    return refs.ledger_by_period(_all_references(spark, d), _timelines(spark, d))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references counted per table, column, month and reason."""
    return refs.orphan_report(p1_found(spark, d))


def p1_current(spark: SparkSession, d: str) -> DataFrame:
    """Keys with positive reference count and zero existence after all deltas."""
    made = _all_references(spark, d).dropDuplicates(["ref_table", "ref_column", "ref_row"])
    made = made.select("kind", "key", F.lit(1).alias("refs"), F.lit(0).alias("exists"))
    live = _timelines(spark, d).select(
        "kind",
        "key",
        F.lit(0).alias("refs"),
        F.aggregate("timeline", F.lit(0), lambda acc, e: acc + e["sign"]).alias("exists"),
    )
    return refs.ledger_orphans(refs.merge_ledger(None, made.unionByName(live))).select("kind", "key", "refs")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.listing_changes(read_table(spark, d, "object_listing"))


def p3_summary(spark: SparkSession, d: str) -> DataFrame:
    """Number of changes of each kind per snapshot."""
    return p3_found(spark, d).groupBy("snapshot_no", "change").agg(F.count("*").alias("n"))


_REF_PARTS = [
    ("point_source", "id", "recorded_at", "point", uuid_sql("id")),
    ("point_source", "path", "recorded_at", "object", path_sql("path")),
    ("clusters", "id", "assigned_at", "point", uuid_sql("id")),
    ("search_result", "query_id", "searched_at", "point", uuid_sql("query_id")),
    ("search_result", "neighbor_id", "searched_at", "point", uuid_sql("neighbor_id")),
    ("wrong_ext", "path", "found_at", "object", path_sql("path")),
]
_REFS = "refs AS (" + " UNION ".join(
    f"SELECT '{t}' AS ref_table, '{c}' AS ref_column, row_id AS ref_row, '{k}' AS kind, {e} AS key, {at} AS t FROM {t} WHERE {c} IS NOT NULL"
    for t, c, at, k, e in _REF_PARTS
) + ")"
_LIVES = f"""
pts AS (SELECT {uuid_sql('id')} AS key, min(created_at) AS born, arg_max(struct_pack(d := deleted_at), (updated_at, idx)).d AS died
        FROM point_metadata GROUP BY 1),
{PRESENT_OBJECTS},
seqs AS (SELECT DISTINCT path AS key, seq, taken_at FROM present JOIN snaps USING (taken_at)),
objs AS (SELECT key, min(taken_at) AS first_at FROM seqs GROUP BY 1)
"""
_P1 = f"""
WITH {_REFS}, {_LIVES},
timed AS (SELECT r.*, s.seq FROM refs r ASOF LEFT JOIN snaps s ON r.t >= s.taken_at),
judged AS (
  SELECT ref_table, ref_column, ref_row, t,
    CASE WHEN kind = 'point' THEN
      CASE WHEN p.key IS NULL THEN 'missing'
           WHEN p.born <= t AND NOT coalesce(p.died <= t, FALSE) THEN NULL
           WHEN p.born <= t THEN 'deleted' ELSE 'late' END
    ELSE
      CASE WHEN o.key IS NULL THEN 'missing'
           WHEN x.key IS NOT NULL THEN NULL
           WHEN o.first_at <= t THEN 'deleted' ELSE 'late' END
    END AS reason
  FROM timed
  LEFT JOIN pts p ON timed.kind = 'point' AND timed.key = p.key
  LEFT JOIN objs o ON timed.kind = 'object' AND timed.key = o.key
  LEFT JOIN seqs x ON timed.kind = 'object' AND timed.key = x.key AND timed.seq = x.seq)
SELECT DISTINCT ref_table, ref_column, ref_row, reason, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS period
FROM judged WHERE reason IS NOT NULL
"""
_P3 = f"""
WITH {PRESENT_OBJECTS},
o AS (SELECT seq, snapshot_no, path, st.etag AS etag, st.content_length AS len, st.last_modified AS lm FROM present JOIN snaps USING (taken_at)),
pairs AS (
  SELECT coalesce(a.seq, b.seq + 1) AS seq, coalesce(a.path, b.path) AS path,
    CASE WHEN b.path IS NULL THEN 'added' WHEN a.path IS NULL THEN 'removed'
         WHEN coalesce(a.etag <> b.etag, FALSE) OR coalesce(a.len <> b.len, FALSE)
           OR coalesce(abs(epoch_us(a.lm) - epoch_us(b.lm)) >= 1000000, FALSE) THEN 'changed' END AS change
  FROM o a FULL JOIN o b ON a.path = b.path AND a.seq = b.seq + 1)
SELECT s.snapshot_no, path, change FROM pairs JOIN snaps s USING (seq) WHERE change IS NOT NULL AND seq > 1
"""
_P1_CURRENT = f"""
WITH {_REFS}, {_LIVES},
alive AS (
  SELECT 'point' AS kind, key FROM pts WHERE born IS NOT NULL AND died IS NULL
  UNION ALL SELECT 'object', key FROM seqs WHERE seq = (SELECT max(seq) FROM snaps))
SELECT kind, key, count(*) AS refs FROM refs ANTI JOIN alive USING (kind, key) WHERE key IS NOT NULL GROUP BY 1, 2
"""

QUERIES = {
    "p1_found": p1_found,
    "p1_method": p1_method,
    "p1_report": p1_report,
    "p1_current": p1_current,
    "p3_found": p3_found,
    "p3_summary": p3_summary,
}
_P1_METHOD = f"""
WITH {_REFS}, {_LIVES},
r AS (SELECT *, strftime(t AT TIME ZONE 'UTC', '%Y-%m') AS period FROM refs WHERE key IS NOT NULL AND t IS NOT NULL),
months AS (SELECT DISTINCT period FROM r),
stay AS (SELECT 'point' AS kind, key, born AS moment, 1 AS sign FROM pts WHERE born IS NOT NULL
  UNION ALL SELECT 'point', key, died, -1 FROM pts WHERE died IS NOT NULL
  UNION ALL SELECT 'object', key, taken_at, 1 FROM seqs
  UNION ALL SELECT 'object', key, s.taken_at, -1 FROM seqs q JOIN snaps s ON s.seq = q.seq + 1),
ex AS (SELECT kind, key, strftime(moment AT TIME ZONE 'UTC', '%Y-%m') AS period, sum(sign) AS n FROM stay GROUP BY ALL),
held AS (SELECT m.period, kind, key, ref_table, ref_column, count(*) AS refs FROM months m JOIN r ON r.period <= m.period GROUP BY ALL),
live AS (SELECT m.period, kind, key, sum(n) AS n FROM months m JOIN ex ON ex.period <= m.period GROUP BY ALL)
SELECT ref_table, ref_column, period, count(*) AS keys, sum(refs)::BIGINT AS refs
FROM held LEFT JOIN live USING (period, kind, key) WHERE coalesce(n, 0) <= 0 GROUP BY 1, 2, 3
"""
ORACLES = {
    "p1_found": _P1,
    "p1_method": _P1_METHOD,
    "p1_report": f"SELECT ref_table, ref_column, period, reason, count(*) AS n FROM ({_P1}) GROUP BY 1, 2, 3, 4",
    "p1_current": _P1_CURRENT,
    "p3_found": _P3,
    "p3_summary": f"SELECT snapshot_no, change, count(*) AS n FROM ({_P3}) GROUP BY 1, 2",
}
