import itertools
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftwell.operators import clusters, complete_link, components, density, extensions, knn, reduction, similarity, triage


def vectors(spark, x, key="id"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{key} bigint, vec array<float>")


def cosines(x):
    n = np.linalg.norm(x, axis=1)
    return x @ x.T / n[:, None] / n[None]


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 12))
    return centres[rng.integers(0, 8, 150)] + 0.4 * rng.normal(size=(150, 12))


def test_similar_pairs_exact(spark, cloud):
    s = cosines(cloud.astype(np.float32).astype(float))
    want = {(i, j) for i, j in itertools.combinations(range(150), 2) if s[i, j] >= 0.8}
    for block in (16, 1000):
        got = {(r["a"], r["b"]) for r in similarity.similar_pairs(vectors(spark, cloud), "id", "vec", 0.8, block_rows=block).collect()}
        assert got == want


def test_similar_pairs_lsh_is_a_subset(spark, cloud):
    exact = {(r["a"], r["b"]) for r in similarity.similar_pairs(vectors(spark, cloud), "id", "vec", 0.95).collect()}
    found = {(r["a"], r["b"]) for r in similarity.similar_pairs(vectors(spark, cloud), "id", "vec", 0.95, strategy="lsh").collect()}
    assert found <= exact and len(found) >= 0.9 * len(exact)


def test_zero_vectors_resemble_nothing(spark):
    rows = vectors(spark, [[0, 0], [0, 0], [1, 0], [2, 0]])
    assert [(r["a"], r["b"]) for r in similarity.similar_pairs(rows, "id", "vec", -1).collect()] == [(2, 3)]
    assert similarity.similar_pairs(rows.limit(0), "id", "vec").count() == 0


def test_threshold_sides(spark):
    rows = vectors(spark, [[3, 4], [4, 3]])  # cosine 0.96
    exact = similarity.similar_pairs(rows, "id", "vec", -2).first()["similarity"]
    assert similarity.similar_pairs(rows, "id", "vec", exact).count() == 1
    assert similarity.similar_pairs(rows, "id", "vec", exact, strict=True).count() == 0


def test_pairs_of_unknown_ids_fail(spark):
    rows = vectors(spark, [[1, 0], [0, 1]])
    with pytest.raises(Exception, match="unknown id 9"):
        similarity.pairs_of_ids(rows, spark.createDataFrame([(0,), (9,)], "id bigint"), "id", "vec").collect()


def union_find(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    pairs = [tuple(map(int, p)) for p in rng.integers(0, 120, (70, 2))]
    nodes = spark.range(120).withColumnRenamed("id", "x")
    got = components.component_labels(nodes, spark.createDataFrame(pairs, "p bigint, q bigint"), "x", "p", "q").collect()
    assert {r["x"]: r["cluster_id"] for r in got} == dict(enumerate(union_find(120, pairs)))


def test_components_of_no_edges(spark):
    got = components.component_labels(spark.range(3), spark.createDataFrame([], "a bigint, b bigint"), "id", "a", "b").collect()
    assert {(r["id"], r["cluster_id"]) for r in got} == {(0, 0), (1, 1), (2, 2)}


def first_fit(ids, s, t):
    out = []
    for i in ids:
        for c in out:
            if all(s[i, j] > t for j in c):
                c.append(i)
                break
        else:
            out.append([i])
    return out


def merged(chunks, s, t):
    out = []
    for chunk in chunks:
        for c in first_fit(chunk, s, t):
            for g in out:
                if all(s[i, j] > t for i in c for j in g):
                    g.extend(c)
                    break
            else:
                out.append(list(c))
    return out


def test_complete_link(spark, cloud):
    s = cosines(cloud.astype(np.float32).astype(float))
    whole = {k: c[0] for c in first_fit(range(150), s, 0.75) for k in c}
    got = complete_link.complete_link(vectors(spark, cloud), "id", "vec", 0.75).collect()
    assert {r["id"]: r["cluster_id"] for r in got} == whole
    parts = [list(range(i, min(i + 40, 150))) for i in range(0, 150, 40)]
    chunked = {k: c[0] for c in merged(parts, s, 0.75) for k in c}
    got = complete_link.complete_link(vectors(spark, cloud), "id", "vec", 0.75, chunk_rows=40).collect()
    assert {r["id"]: r["cluster_id"] for r in got} == chunked


@pytest.mark.parametrize("chunk_rows", [None, 40])
def test_complete_link_in_groups_of_any_size(spark, cloud, monkeypatch, chunk_rows):
    whole = {r["id"]: r["cluster_id"] for r in complete_link.complete_link(vectors(spark, cloud), "id", "vec", 0.75, chunk_rows=chunk_rows).collect()}
    monkeypatch.setattr(complete_link, "_EDGES_A_GROUP", 3)
    assert {r["id"]: r["cluster_id"] for r in complete_link.complete_link(vectors(spark, cloud), "id", "vec", 0.75, chunk_rows=chunk_rows).collect()} == whole


@pytest.mark.parametrize("rows", [1, 2_000])
def test_complete_link_of_given_groups(spark, cloud, monkeypatch, rows):
    """Groups of bounded size in one pass and larger ones by components give what the definition says."""
    monkeypatch.setattr(complete_link, "_GROUP_ROWS", rows)
    monkeypatch.setattr(complete_link, "_ROWS_A_PART", 20)
    monkeypatch.setattr(complete_link, "_PAIRS_AT_ONCE", 50)
    seen = []
    parts = complete_link._link_by_components
    monkeypatch.setattr(complete_link, "_link_by_components", lambda *a: seen.append(1) or parts(*a))
    table = vectors(spark, cloud).withColumn("g", F.when(F.col("id") % 10 > 0, F.col("id") % 3))
    got = {r["id"]: r["cluster_id"] for r in complete_link.complete_link(table, "id", "vec", 0.75, group="g").collect()}
    x = np.asarray(cloud, float)
    want = {}
    for g in range(3):
        found = []
        for i in (i for i in range(len(x)) if i % 3 == g and i % 10):
            alike = lambda j: x[i] @ x[j] > 0.75 * np.linalg.norm(x[i]) * np.linalg.norm(x[j])  # noqa: B023, E731
            home = next((c for c in found if all(map(alike, c))), None)
            found.append(home := []) if home is None else None
            home.append(i)
            want[i] = home[0]
    assert got == {i: want.get(i, i) for i in range(len(x))}
    assert len(seen) == (rows == 1)


def test_vectors_of_a_group_have_one_length(spark):
    rows = spark.createDataFrame([(1, 1, [1.0, 0.0]), (2, 1, [2.0, 0.0]), (3, 2, [1.0]), (4, 2, [-1.0]), (5, 2, None), (6, 2, [0.0])], "id bigint, g bigint, vec array<float>")
    assert {tuple(r) for r in complete_link.complete_link(rows, "id", "vec", 0.5, group="g").collect()} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6)}
    with pytest.raises(Exception, match="unequal length"):
        complete_link.complete_link(rows.withColumn("g", F.lit(1)), "id", "vec", 0.5, group="g").collect()


def test_fold_takes_many_components_at_a_linear_cost():
    def fold(n):
        """n components a - b - c without the pair a, c: c is left over."""
        at = np.arange(3 * n)
        members = pd.DataFrame({"root": at // 3 * 3, "at": at, "chunk": 0, "key": at}).sample(frac=1, random_state=1)
        edges = pd.DataFrame({"a": np.r_[at[0::3], at[1::3]], "b": np.r_[at[1::3], at[2::3]]})
        began = time.perf_counter()
        got = complete_link._fold(members, edges)
        taken = time.perf_counter() - began
        assert dict(zip(got["key"], got["first"])) == {k: k if k % 3 == 2 else k // 3 * 3 for k in range(3 * n)}
        return taken

    assert min(fold(4000) for _ in range(3)) < 40 * min(fold(250) for _ in range(3))


def test_fold_leaves_records_of_no_chunk_alone():
    members = pd.DataFrame({"root": [1, 1, 5, 5], "at": [1.0, 2.0, 5.0, None], "chunk": [0.0, 0.0, 0.0, None], "key": [1, 2, 5, 6]})
    got = complete_link._fold(members, pd.DataFrame({"a": [1, 5], "b": [2, 6]}))
    assert dict(zip(got["key"], got["first"])) == {1: 1, 2: 1, 5: 5}


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_knn(spark, cloud, metric):
    x = cloud.astype(np.float32).astype(float)
    d = 1 - cosines(x) if metric == "cosine" else np.linalg.norm(x[:, None] - x[None], axis=2)
    np.fill_diagonal(d, np.inf)
    rows = vectors(spark, cloud)
    got = {}
    for r in knn.knn_join(rows.where("id < 20"), rows, "id", "vec", 5, metric, block_rows=32).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["neighbor_id"]
    assert {q: [v[k] for k in sorted(v)] for q, v in got.items()} == {q: list(np.argsort(d[q], kind="stable")[:5]) for q in range(20)}


def test_knn_hamming_and_index(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"\x00\x00"), ("b", b"\x01\x00"), ("c", b"\xff\xff"), ("n", None)], "id string, vec binary")
    got = {(r["query_id"], r["neighbor_id"], r["distance"]) for r in knn.knn_join(rows, rows, "id", "vec", 1, "hamming_share").collect()}
    assert got == {("a", "b", 0.5), ("b", "a", 0.5), ("c", "a", 1.0)}
    index = knn.KnnIndex(rows, metric="hamming_bits").insert(spark.createDataFrame([("c", b"\x03\x00")], "id string, vec binary"))
    index.save(str(tmp_path / "index"))
    again = knn.KnnIndex.load(spark, str(tmp_path / "index"), metric="hamming_bits")
    assert [r["neighbor_id"] for r in again.search(b"\x03\x00", 2).orderBy("rank").collect()] == ["c", "b"]


def test_dbscan_and_hdbscan(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 16))
    x = np.vstack([a + 0.05 * rng.normal(size=(12, 16)), b + 0.05 * rng.normal(size=(9, 16)), rng.normal(size=(3, 16))])
    got = density.dbscan(vectors(spark, x), "id", "vec", 0.1, 3).collect()
    labels = {r["id"]: r["cluster_id"] for r in got}
    assert all(labels[i] == 0 for i in range(12)) and all(labels[i] == 12 for i in range(12, 21)) and all(labels[i] is None for i in range(21, 24))
    got = {r["id"]: r["cluster_id"] for r in density.hdbscan(vectors(spark, x), "id", "vec", 0.6, min_samples=2, min_size=3).collect()}
    assert len({got[i] for i in range(12)} - {None}) >= 1 and not {got[i] for i in range(12)} & ({got[i] for i in range(12, 21)} - {None})


def test_hdbscan_spans_all_pairs(spark, tiny):
    import pandas as pd

    from siftwell.plans import curation

    rows = spark.read.parquet(f"{tiny}/embeddings.parquet").orderBy("vec_id").toPandas()
    ids, x = rows["vec_id"].tolist(), np.stack(rows["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = np.sqrt(np.maximum(2 - 2 * x @ x.T, 0))
    np.fill_diagonal(d, np.inf)
    core = d.min(axis=1)
    w = np.maximum(d, np.maximum(core[:, None], core[None]))
    inside, edges, reach, source = [0], [], w[0].copy(), np.zeros(len(x), int)
    while len(inside) < len(x):
        reach[inside] = np.inf
        j = int(reach.argmin())
        edges.append((ids[min(j, source[j])], ids[max(j, source[j])], reach[j]))
        inside.append(j)
        nearer = w[j] < reach
        reach[nearer], source[nearer] = w[j][nearer], j
    want = density.condense(pd.DataFrame(edges, columns=["a", "b", "w"]), ids, 2)
    got = {r["vec_id"]: r["cluster_id"] for r in curation.hdbscan(spark, tiny).collect()}
    assert {k: v for k, v in got.items() if v is not None} == want and len(got) == len(ids)
    frame = spark.read.parquet(f"{tiny}/embeddings.parquet")
    blocks = {r["vec_id"]: r["cluster_id"] for r in density.hdbscan(frame, "vec_id", "embedding", block_rows=150).collect()}
    assert blocks == got


def test_spanning_forest(spark):
    from siftwell.runtime import Workspace

    rng = np.random.default_rng(4)
    edges = [(int(a), int(b), float(w)) for a, b, w in zip(rng.integers(0, 25, 120), rng.integers(25, 50, 120), rng.permutation(120))]
    got = density.minimum_spanning_forest(spark.createDataFrame(edges, "a bigint, b bigint, w double"), Workspace(spark)).collect()
    total, chosen = 0.0, []
    for a, b, w in sorted(edges, key=lambda e: e[2]):
        roots = union_find(50, chosen)
        if roots[a] != roots[b]:
            chosen.append((a, b))
            total += w
    assert len(got) == len(chosen) and sum(r["w"] for r in got) == total


def test_condense_by_hand():
    import pandas as pd

    edges = pd.DataFrame([(0, 1, 0.1), (1, 2, 0.1), (3, 4, 0.1), (4, 5, 0.1), (2, 3, 5.0)], columns=["a", "b", "w"])
    assert density.condense(edges, list(range(6)), 2) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}


def test_optics(spark):
    rows = spark.createDataFrame([(i, bytes(v)) for i, v in enumerate([[0, 0, 0], [0, 0, 1], [0, 2, 1], [9, 9, 9], [9, 9, 8], [5, 6, 7]])], "id bigint, vec binary")
    got = {r["id"]: r["cluster_id"] for r in density.optics(rows, "id", "vec", eps=1.0).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: None}


def test_embedding_of_all_vectors(spark, tiny):
    from siftwell.plans import curation

    found = curation.pacmap_embedding(spark, tiny).groupBy("step").count().collect()
    rows = spark.read.parquet(f"{tiny}/embeddings.parquet").count()
    assert {r["step"]: r["count"] for r in found} == dict.fromkeys([None, *range(100, 900, 100)], rows)


def test_reduction_keeps_neighbours(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([c + 0.1 * rng.normal(size=(20, 20)) for c in 5 * rng.normal(size=(4, 20))])
    y, kept = reduction.embed(x, phases=(60, 60, 120), snapshots=(60,))
    d = np.linalg.norm(y[:, None] - y[None], axis=2) + np.where(np.eye(80), np.inf, 0)
    assert (np.argsort(d, axis=1)[:, :5] // 20 == np.arange(80)[:, None] // 20).mean() > 0.95 and set(kept) == {60}


def test_cluster_reports(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "a"), (3, "b"), (4, "x"), (4, "y"), (4, "z"), (4, "w")], "cluster_id bigint, id string")
    stats = clusters.size_statistics(clusters.cluster_sizes(rows)).first()
    assert (stats["n"], stats["min"], stats["max"], stats["median"], stats["mode"]) == (3, 2, 4, 2.0, 2)
    empty = clusters.size_statistics(clusters.cluster_sizes(rows.limit(0))).first()
    assert (empty["n"], empty["median"], empty["mode"]) == (0, None, None)
    assert [tuple(r) for r in clusters.size_histogram(clusters.cluster_sizes(rows)).collect()] == [(2, 2), (4, 1)]
    first = clusters.largest_clusters(rows, "cluster_id", "id", preview=2).first()
    assert (first["cluster_id"], first["size"], first["preview"]) == (4, 4, ["w", "x"])


def run_triage(spark, members, points):
    m = spark.createDataFrame([(1, i) for i in members] + [(1, members[0])], "cluster_id bigint, id string")
    p = spark.createDataFrame(points, "id string, size bigint, ext string, text_vector array<float>")
    return {r["id"]: r["action"] for r in triage.triage_clusters(m, p).collect()}


U, V = [1.0, 0.0], [0.0, 1.0]


def test_triage_all_text(spark):
    got = run_triage(spark, "abc", [("a", 10, "jpg", U), ("b", 20, "jpg", U), ("c", None, "gif", V)])
    assert got == {"a": "other_delete", "b": "kept_text", "c": "kept_text"}
    assert run_triage(spark, "a", [("a", 1, "jpg", U)]) == {"a": "kept_text"}


def test_triage_gifs(spark):
    got = run_triage(spark, "abcd", [("a", 1, "gif", None), ("b", 2, "gif", None), ("c", 9, "jpg", None), ("d", 1, "GIF", None)])
    assert got == {"a": "gif_triage", "b": "gif_triage", "c": "other_delete", "d": "other_delete"}


def test_triage_no_gif_ties_and_unknown(spark):
    got = run_triage(spark, "abcd", [("a", 1, "jpg", None), ("b", 5, "jpg", None), ("c", 5, "jpg", None)])
    assert got == {"a": "other_delete", "b": "other_delete", "c": "kept_non_gif", "d": "other_delete"}


def test_gifs_and_transfer(spark):
    triaged = spark.createDataFrame([(1, i, "gif_triage") for i in "abcde"] + [(1, "z", "other_delete")], "cluster_id bigint, id string, action string")
    gifs = spark.createDataFrame([("a", "ok", U), ("b", "ok", U), ("c", "ok", V), ("d", "same_frame", None)], "id string, status string, embedding array<float>")
    points = spark.createDataFrame([("a", 1, ["own"]), ("b", 3, None), ("c", 2, ["own"]), ("d", 1, ["x"]), ("e", 1, ["y"]), ("z", 1, None)], "id string, size bigint, categories array<string>")
    settled = triage.settle_gifs(triaged, gifs, points)
    assert {r["id"]: r["action"] for r in settled.collect()} == {"a": "duplicate_gif", "b": "kept_gif", "c": "kept_gif", "d": "same_frame_gif", "e": "invalid_gif", "z": "other_delete"}
    plan = triage.tag_transfer(settled, points)
    ops = {r["id"]: (r["op"], r["categories"]) for r in plan.collect()}
    assert ops["b"] == ("upsert", ["own", "x", "y"]) and ops["c"] == ("upsert", ["own", "x", "y"]) and ops["a"] == ("delete", None)
    after = {r["id"]: r["categories"] for r in triage.apply_transfer(points, plan).collect()}
    assert after == {"b": ["own", "x", "y"], "c": ["own", "x", "y"]}
    wide = triage.final_classification(settled).first()
    assert wide["kept_gif"] == ["b", "c"] and wide["kept_text"] is None


def test_transfer_takes_one_table_of_fates(spark):
    """The plan is read once: each further reading would work out the whole settled table's tags again."""
    plan = spark.createDataFrame([(1, "a", "upsert", ["x"]), (2, "a", "upsert", ["b", "x"]), (3, "a", "delete", None), (1, "d", "delete", None), (2, "e", "upsert", []), (1, "gone", "delete", None)], "cluster_id bigint, id string, op string, categories array<string>")
    points = spark.createDataFrame([("a", ["old"]), ("d", ["y"]), ("e", ["z"]), ("f", None), (None, ["n"])], "id string, categories array<string>")
    after = triage.apply_transfer(points, plan)
    assert {r["id"]: r["categories"] for r in after.collect()} == {"a": ["b", "x"], "e": [], "f": None, None: ["n"]}
    text = after._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") == 1


def test_extension_checks(spark):
    jpeg, png = b"\xff\xd8\xff\xe0", b"\x89PNG\r\n\x1a\n"
    files = spark.createDataFrame([("d/a.JPG", jpeg), ("noext", png), ("x.png", png), ("y.png", b"??"), ("z.png", None)], "path string, content binary")
    got = lambda how: {r["path"]: (r["status"], r["expected_ext"]) for r in extensions.extension_verdicts(files, compare=how).collect()}
    assert got("local") == {"d/a.JPG": ("ok", None), "noext": ("wrong", "png"), "x.png": ("ok", None), "y.png": ("failed", None), "z.png": ("failed", None)}
    assert got("remote")["d/a.JPG"] == ("wrong", "jpg") and got("ingest")["noext"] == ("wrong", "png")
    wrong, failed = extensions.split_verdicts(extensions.extension_verdicts(files))
    assert wrong.count() == 2 and failed.count() == 2


def test_plans(spark):
    wrong = spark.createDataFrame([("a.b.png", "jpg"), ("d.x/c.jpeg", "jpg"), ("e.gif", "png"), (None, "jpg")], "path string, expected_ext string")
    renames = {r["src"]: r["dst"] for r in extensions.rename_plan(wrong, include=[("png", "jpg"), ("jpeg", "jpg")], skip=[("jpeg", "jpg")]).collect()}
    assert renames == {"a.b.png": "a.jpg"}
    payloads = {r["point_id"]: (r["dst"], r["url"]) for r in extensions.payload_plan(wrong, "https://h").collect()}
    assert payloads["c"] == ("c.jpg", "https://h/c.jpg")
    points = spark.createDataFrame([("c", "jpeg", "old"), ("q", None, None)], "id string, format string, url string")
    after = {r["id"]: (r["format"], r["url"]) for r in extensions.update_payload(points, extensions.payload_plan(wrong, "https://h")).collect()}
    assert after == {"c": ("jpg", "https://h/c.jpg"), "q": (None, None)}
    kept = extensions.filter_paths(wrong, include=["a.", "gif"], exclude=["gif"]).collect()
    assert [r["path"] for r in kept] == ["a.b.png"]


def test_ingest_plan(spark):
    files = spark.createDataFrame([("in/a.png", b"\xff\xd8\xff"), ("in/b", b"zz"), ("in/c.gif", b"GIF89a")], "path string, content binary")
    plan = {r["src"]: r for r in extensions.ingest_plan(files, "/out/").collect()}
    assert plan["in/a.png"]["dst"].endswith(".jpg") and plan["in/a.png"]["wrong_ext"] == "jpg" and plan["in/b"]["action"] == "failed"
    there = spark.createDataFrame([(plan["in/c.gif"]["dst"],)], "dst string")
    again = {r["src"]: r["action"] for r in extensions.ingest_plan(files, "/out/", existing=there).collect()}
    assert again["in/c.gif"] == "skip" and again["in/a.png"] == "copy"
    moved = {r["src"]: r["action"] for r in extensions.ingest_plan(files, "/out", move=True, existing=there).collect()}
    assert moved["in/c.gif"] == "move"


def test_seeded_sample(spark):
    rows = spark.range(100)
    seeds = spark.createDataFrame([(5,), (200,)], "id bigint")
    a = {r["id"] for r in density.seeded_sample(rows, "id", seeds, 10, 1).collect()}
    assert len(a) == 11 and 5 in a and a == {r["id"] for r in density.seeded_sample(rows.repartition(7), "id", seeds, 10, 1).collect()}
    assert a != {r["id"] for r in density.seeded_sample(rows, "id", seeds, 10, 2).collect()}


def test_pick_largest(spark):
    rows = spark.createDataFrame([("a", None), ("b", 3), ("c", 3)], "id string, size bigint")
    assert rows.agg(clusters.pick_largest(F.col("size"), F.col("id"))).first()[0] == "c"
