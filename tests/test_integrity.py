import datetime as dt

from pyspark.sql import functions as F

from siftwell.operators import references as refs
from siftwell.operators import snapshots

UTC = dt.timezone.utc
A, B, C = (f"00000000-0000-0000-0000-00000000000{i}" for i in (1, 2, 3))


def day(m, d=1, h=0):
    return dt.datetime(2024, m, d, h, tzinfo=UTC)


LISTING = "snapshot_no int, taken_at timestamp, path string, mode string, is_deleted boolean, content_length bigint, etag string, last_modified timestamp, extra string"
POINTS = "idx bigint, id string, created_at timestamp, updated_at timestamp, deleted_at timestamp, key string"


def listing(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], LISTING)


def changes(spark, rows):
    return {tuple(r) for r in snapshots.listing_changes(listing(spark, rows)).collect()}


def test_changes(spark):
    rows = [
        (1, day(1), "a/x", "FILE", False, 5, '"AB"', day(1)),
        (1, day(1), "a/same", "FILE", None, 5, "e", day(1)),
        (1, day(1), "a/gone", "FILE", False, 5, None, None),
        (1, day(1), "a/", "DIR", False, 0, None, None),
        (3, day(3), "./a//x", "FILE", False, 5, 'W/"ab"', day(1) + dt.timedelta(milliseconds=900)),
        (3, day(3), "a/same", "FILE", False, 6, "e", day(1)),
        (3, day(3), "a/same", "FILE", False, 5, "e", day(1) - dt.timedelta(days=1)),  # outdated
        (3, day(3), "a/gone", "FILE", True, 0, None, day(2)),
        (3, day(3), "a/new", "FILE", False, None, None, None),
        (3, day(3), "a/new", "FILE", False, None, None, None),
        (3, day(3), None, "FILE", False, None, None, None),
    ]
    assert changes(spark, rows) == {(3, "a/same", "changed"), (3, "a/gone", "removed"), (3, "a/new", "added")}


def test_changes_null_compares_equal_and_seconds_count(spark):
    base = (1, day(1), "p", "FILE", False, None, "e", day(1))
    assert changes(spark, [base, (2, day(2), "p", "FILE", False, 7, None, day(1))]) == set()
    assert changes(spark, [base, (2, day(2), "p", "FILE", False, None, "e", day(1) + dt.timedelta(seconds=1))]) == {(2, "p", "changed")}


def test_changes_empty_and_single(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [(1, day(1), "p", "FILE", False, 1, "e", day(1))]) == set()


def test_changes_one_object_repeated(spark):
    many = [(n, day(n), "hot", "FILE", False, 1, "e", day(1)) for n in (1, 2) for _ in range(400)]
    assert changes(spark, [*many, (2, day(2), "other", "FILE", False, 1, "e", day(1))]) == {(2, "other", "added")}


def orphans(spark, references, points, rows):
    known = refs.point_timeline(spark.createDataFrame([(*p, "k") for p in points], POINTS)).unionByName(refs.object_timeline(listing(spark, rows)))
    made = spark.createDataFrame(references, "ref_table string, ref_column string, ref_row bigint, kind string, key string, t timestamp")
    return {(r["ref_row"], r["reason"], r["period"]) for r in refs.orphan_references(made, known).collect()}


def test_orphans_points(spark):
    points = [(1, A, day(2), day(2), None), (2, A, day(2), day(4), day(5)), (3, B, None, day(1), None), (1, A, day(2), day(2), None)]
    ref = lambda n, key, t: ("t", "c", n, "point", key, t)
    made = [ref(1, A, day(1)), ref(2, A, day(2)), ref(3, A, day(5)), ref(4, A, day(4)), ref(5, C, day(4)), ref(5, C, day(4)), ref(6, B, day(3)), ref(7, "odd", day(3))]
    assert orphans(spark, made, points, []) == {
        (1, "late", "2024-01"), (3, "deleted", "2024-05"), (5, "missing", "2024-04"), (6, "late", "2024-03"), (7, "missing", "2024-03")
    }


def test_orphans_objects(spark):
    row = lambda n, p, deleted=False, mode="FILE": (n, day(n), p, mode, deleted, 1, "e", day(1))
    rows = [row(1, "a"), row(2, "./a"), row(4, "a"), row(3, "b"), row(1, "c", True), row(2, "d", mode="DIR"), row(3, "a", True)]
    ref = lambda n, key, t: ("t", "path", n, "object", key, t)
    made = [ref(1, "a", day(2, 5)), ref(2, "a", day(3, 5)), ref(3, "a", day(5)), ref(4, "b", day(2)), ref(5, "c", day(2)), ref(6, "b", day(4)), ref(7, "d", day(3)), ref(8, "a", dt.datetime(2023, 12, 31, tzinfo=UTC))]
    assert orphans(spark, made, [], rows) == {
        (2, "deleted", "2024-03"), (4, "late", "2024-02"), (5, "missing", "2024-02"), (6, "deleted", "2024-04"), (7, "missing", "2024-03"), (8, "late", "2023-12")
    }


def test_null_references_refer_to_nothing(spark):
    source = spark.createDataFrame([(1, None, None, day(1)), (2, A, "./p", day(1)), (3, "", "p", None)], "row_id bigint, id string, path string, recorded_at timestamp")
    clusters = spark.createDataFrame([], "row_id bigint, id string, assigned_at timestamp")
    found = spark.createDataFrame([], "row_id bigint, query_id string, neighbor_id string, searched_at timestamp")
    wrong = spark.createDataFrame([], "row_id bigint, path string, found_at timestamp")
    got = {(r["ref_column"], r["ref_row"], r["key"]) for r in refs.collect_references(source, clusters, found, wrong).collect()}
    assert got == {("id", 2, A), ("path", 2, "p")}


def test_ledger_increments_equal_one_pass(spark):
    schema = "kind string, key string, refs int, exists int"
    first = spark.createDataFrame([("point", "a", 1, 0), ("point", "a", 1, 0), ("point", "b", 1, 1), ("point", None, 1, 0)], schema)
    second = spark.createDataFrame([("point", "a", -1, 1), ("point", "b", 0, -1), ("point", "c", None, None)], schema)
    state = refs.merge_ledger(refs.merge_ledger(None, first), second)
    assert {tuple(r) for r in state.collect()} == {("point", "a", 1, 1), ("point", "b", 1, 0)}
    assert {tuple(r) for r in refs.merge_ledger(None, first.union(second)).collect()} == {tuple(r) for r in state.collect()}
    assert [r["key"] for r in refs.ledger_orphans(state).collect()] == ["b"]


def test_timeline_from_deltas(spark):
    rows = [("point", "a", day(1), 1), ("point", "a", day(1), 1), ("point", "a", day(2), -1), ("point", "a", day(3), 1), ("point", "a", day(3), -1)]
    line = refs.timeline_from_deltas(spark.createDataFrame(rows, "kind string, key string, at timestamp, sign int")).first()["timeline"]
    assert [e["sign"] for e in line] == [2, -1]


def test_hot_reference_key(spark):
    points = spark.range(1).select(F.lit(1).alias("idx"), F.lit(A).alias("id"), F.lit(day(2)).alias("created_at"), F.lit(day(2)).alias("updated_at"), F.lit(None).cast("timestamp").alias("deleted_at"))
    made = spark.range(20_000).select(F.lit("t").alias("ref_table"), F.lit("c").alias("ref_column"), F.col("id").alias("ref_row"), F.lit("point").alias("kind"), F.lit(A).alias("key"), F.lit(day(1)).alias("t"))
    assert refs.orphan_references(made, refs.point_timeline(points)).count() == 20_000
