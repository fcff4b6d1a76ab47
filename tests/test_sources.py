import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.sources import files, point_table
from siftwell.sources.point_table import PointTable


def table(spark, rows, dim=3, **options):
    df = spark.createDataFrame([(i, k, [float(x) for x in v]) for i, (k, v) in enumerate(rows)], "at bigint, id string, vec array<float>")
    builder = PointTable.builder(dim).rows(df, "at")
    for key, prefix in options.get("prefixes", {}).items():
        builder = builder.uri_prefix(key, prefix)
    if "ext" in options:
        builder = builder.ext(options["ext"])
    return builder.build(spark)


def order(t):
    return [r["id"] for r in t.ids().collect()]


def test_two_equal_vectors(spark):
    t = table(spark, [("a", [1, 1, 1]), ("b", [1, 1, 1])])
    assert len(t) == 2 and t.similarity("a", "b") == pytest.approx(1, abs=1e-6)


def test_index_and_unknown(spark):
    t = table(spark, [("z", [1, 0, 0]), ("a", [0, 1, 0])])
    assert t.index_to_id(1) == "a" and t.index_to_id(2) is None and t.id_to_index("z") == 0 and t.id_to_index("q") is None
    assert t.similarity("z", "a") == 0
    with pytest.raises(KeyError):
        t.similarity("z", "q")
    assert t.vector("a") == [0, 1, 0] and t.vector("q") is None


def test_upsert_keeps_place_and_remove_closes_gaps(spark):
    t = table(spark, [("c", [1, 0, 0]), ("a", [2, 0, 0]), ("b", [3, 0, 0])])
    new = spark.createDataFrame([(1, "d", [9.0, 0.0, 0.0]), (2, "a", [7.0, 0.0, 0.0]), (3, "a", [8.0, 0.0, 0.0]), (0, "e", [5.0, 0.0, 0.0])], "at bigint, id string, vec array<float>")
    t = t.insert(new, "at")
    assert order(t) == ["c", "a", "b", "e", "d"] and t.vector("a") == [8, 0, 0]
    t = t.remove(spark.createDataFrame([("a",), ("none",)], "id string"))
    assert order(t) == ["c", "b", "e", "d"] and [r["idx"] for r in t.rows.orderBy("idx").collect()] == [0, 1, 2, 3]
    found = {r["id"]: r["found"] for r in t.contains(spark.createDataFrame([("a",), ("b",)], "id string")).collect()}
    assert found == {"a": False, "b": True}
    assert t.clear().is_empty() and not t.is_empty() and [k for k, _ in t] == ["c", "b", "e", "d"]


def test_wrong_length_is_an_error(spark):
    with pytest.raises(Exception, match="expected 3 elements, got 2"):
        len(table(spark, [("a", [1, 0])]))


def test_round_trip(spark, tmp_path):
    x = np.random.default_rng(42).normal(size=(200, 16)).astype(np.float32)
    t = table(spark, [(f"p{i:03d}", row) for i, row in enumerate(x)], dim=16)
    t.save(str(tmp_path / "t"))
    again = PointTable.builder(16).path(str(tmp_path / "t")).build(spark)
    assert order(again) == order(t)
    for a, b in ((0, 1), (5, 150)):
        assert again.similarity(f"p{a:03d}", f"p{b:03d}") == pytest.approx(t.similarity(f"p{a:03d}", f"p{b:03d}"), abs=1e-6)


def test_uris(spark):
    ext = spark.createDataFrame([("a", "jpg")], "id string, ext string")
    t = table(spark, [("a", [1, 0, 0]), ("b", [0, 1, 0])], ext=ext, prefixes={"u": "https://example.com/resources/", "p": "/path/to/resources/", "w": "C:\\path\\to\\resources\\"})
    assert {r["id"]: r["uri"] for r in t.uris("u").collect()} == {"a": "https://example.com/resources/a.jpg", "b": None}
    assert {r["uri"] for r in t.uris("unknown").collect()} == {None}
    assert {r["key"]: r["kind"] for r in t.prefix_kinds().collect()} == {"u": "url", "p": "path", "w": "path"}


def test_scan_and_lookup(spark):
    points = spark.createDataFrame([("00000000-0000-0000-0000-000000000001", [1.0], None), ("5", [1.0], None), ("00000000-0000-0000-0000-000000000002", None, [2.0])], "id string, image_vector array<float>, other array<float>")
    assert point_table.scan_points(points).count() == 1
    assert point_table.points_by_ids(points, points.select("id").limit(1)).count() == 1


def test_must_match(spark):
    rows = spark.createDataFrame([("a",)], "id string")
    lookup = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x")], "id string, at int, path string")
    assert point_table.must_match(rows, lookup, "id", "at", "path").first()["path"] == "new"
    with pytest.raises(Exception, match="no row for q"):
        point_table.must_match(spark.createDataFrame([("q",)], "id string"), lookup, "id", "at", "path").collect()


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.png").write_bytes(b"\xff\xd8\xff" + b"x" * 9000)
    (tmp_path / "in" / "deep" / "b.jpg").write_bytes(b"x")
    return tmp_path


def test_walk_and_heads(spark, tree):
    root = f"file://{tree}/in"
    assert files.list_objects(spark, root).count() == 2 and files.list_objects(spark, root, recursive=False).count() == 1
    assert files.walk_files(spark, [f"{root}/a.png", f"{root}/deep", "file:///nowhere"]).count() == 2
    assert files.walk_files(spark, ["file:///nowhere"]).count() == 0
    heads = {os.path.basename(r["path"]): r for r in files.read_heads(files.with_point_id(files.list_objects(spark, root))).collect()}
    assert len(heads["a.png"]["head"]) == files.HEAD_BYTES and heads["b.jpg"]["head"] == b"x" and heads["a.png"]["point_id"] == "a"
    lost = spark.createDataFrame([("/nowhere/x",)], "path string")
    assert files.read_heads(lost).first()["error"] == "FileNotFoundError"


def test_carry_out(spark, tree):
    a, b = f"{tree}/in/a.png", f"{tree}/out/a.jpg"
    plan = spark.createDataFrame([(a, b, "copy"), (f"{tree}/none", f"{tree}/out/n", "move")], "src string, dst string, action string")
    assert {r["outcome"] for r in files.carry_out(plan, action="action").collect()} == {"planned"} and not os.path.exists(b)
    done = {r["src"]: r["outcome"] for r in files.carry_out(plan, action="action", apply=True).collect()}
    assert done[a] == "done" and done[f"{tree}/none"].startswith("failed") and os.path.exists(a) and os.path.exists(b)
    assert files.carry_out(plan.limit(1), action="action", apply=True).first()["outcome"] == "skipped"
    renames = plan.limit(1).withColumn("dst", F.lit(f"{tree}/in/c.jpg"))
    assert files.carry_out(renames, apply=True).first()["outcome"] == "done" and not os.path.exists(a)
    assert files.carry_out(renames, apply=True).first()["outcome"] == "done"  # a repeated task


def test_writes(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    files.write_checkpointed(one, str(tmp_path / "c"))
    files.write_checkpointed(two, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1
    files.write_checkpointed(two, str(tmp_path / "c"), overwrite=True)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    files.write_verdicts(one, two.limit(0), str(tmp_path / "v"))
    assert (tmp_path / "v_wrong.json").exists() and (tmp_path / "v_failed.json").exists()
    assert files.write_errors(one, str(tmp_path / "e")) and not files.write_errors(one.limit(0), str(tmp_path / "f"))
    assert not (tmp_path / "f").exists()


def test_parse_ids(spark):
    rows = spark.createDataFrame([("6C439572-44ed-5ba9-a6fb-627b06406c73", 1), ("5", 2), ("cover", 3), (None, 4)], "name string, n int")
    good, bad = files.parse_ids(rows, "name")
    assert {(r["n"], r["id"]) for r in good.collect()} == {(1, "6c439572-44ed-5ba9-a6fb-627b06406c73"), (2, "00000000-0000-0000-0000-000000000005")}
    assert {r["stem"] for r in bad.collect()} == {"cover", None}


def test_filter_config(tmp_path):
    (tmp_path / "c.json").write_text('{"include_files": ["a"], "exclude_files": ["b"]}')
    assert files.load_filter_config(str(tmp_path / "c.json"), include=["x"]) == {"include": ["a", "x"], "exclude": ["b"]}
    assert files.load_filter_config() == {"include": [], "exclude": []}


def test_downloads(spark, tree):
    ids = spark.createDataFrame([("a",), ("a",), (None,), ("gone",)], "id string")
    plan = files.download_plan(ids, f"{tree}/in", f"{tree}/out", "png")
    outcomes = {r["src"].rsplit("/", 1)[-1]: r["outcome"] for r in files.carry_out(plan, action="action", apply=True).collect()}
    assert outcomes["a.png"] == "done" and outcomes["gone.png"].startswith("failed")
    assert {r["outcome"] for r in files.carry_out(plan.where("id = 'a'"), action="action", apply=True).collect()} == {"skipped"}


def test_store_settings():
    got = files.object_store_settings({"AWS_ACCESS_KEY_ID": "k", "AWS_ENDPOINT_URL": "http://e"})
    assert got == {"spark.hadoop.fs.s3a.access.key": "k", "spark.hadoop.fs.s3a.endpoint": "http://e", "spark.hadoop.fs.s3a.attempts.maximum": "20"}


def test_workspace_scope_and_metrics(spark, monkeypatch):
    import os

    from siftwell import runtime

    with runtime.Workspace(spark, "scope") as work:
        held = work.save(spark.range(7), rows=F.count(F.lit(1)), top=F.max("id"))
        assert (work.metric(held), work.metric(held, "top"), held.count()) == (7, 6, 7)
        assert os.path.isdir(work.root.removeprefix("file:"))
    assert not os.path.isdir(work.root.removeprefix("file:"))

    class Far:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(RuntimeError):
        runtime.checkpoint_root(Far)
