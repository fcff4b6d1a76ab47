"""Neighbours by Hilbert curves, and deduplication against history."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.llm import history, neighbours, vectors


def test_hilbert_visits_every_cell_once_by_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = neighbours.hilbert_index(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_window_best_against_brute_force():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[5] = x[9]
    rid, own = rng.permutation(700), np.arange(700) % 5 != 0
    q, other, value = neighbours.window_best(x, rid, own, 700, 10, block=128)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    for i in np.flatnonzero(own)[::17]:
        want = rid[np.lexsort((rid, -s[i].round(12)))[:10]]
        assert set(other[q == rid[i]]) == set(want)
    assert not set(q) & set(rid[~own]) and value.max() <= 1 + 1e-9


@pytest.mark.parametrize("window", [3, 40, 700])
def test_windows_in_tiles_and_along_a_slide(window):
    rng = np.random.default_rng(2)
    x = neighbours._pack16(neighbours._unit(rng.normal(size=(900, 8))))
    x[100:140] = x[100]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    rid, own = rng.permutation(900), np.arange(900) % 3 != 0
    tiled, whole = (set(zip(*(a.tolist() for a in neighbours.window_best(unit, rid, own, window, 5, block=64, tile=t)[:2]))) for t in (37, 10_000))
    assert tiled == whole
    slide, found = neighbours.Slide(window, 5), []
    slide.step = 50
    for _ in range(2):  # a second cell begins anew
        for part in np.array_split(np.arange(900), 23):
            found += list(slide.add(rid[part], own[part], x[part]))
            assert slide.rows <= 3 * window + 200
        found += list(slide.finish())
    assert all(len(f) for f in found) and list(slide.add(rid[:5], np.zeros(5, bool), x[:5])) == [] == list(slide.finish())
    q = [len(r) for f in found for r in f["other"]]
    lists = {r: set(o.tolist()) for f in found for r, o in zip(f["rid"], f["other"])}
    assert len(q) == 2 * own.sum()
    at = {r: i for i, r in enumerate(rid.tolist())}
    for i in np.flatnonzero(own):  # a block of rows sees a little beyond the window, so a list may be better
        near = [j for j in range(max(0, i - window), min(900, i + window + 1)) if j != i]
        want = sorted((unit[i] @ unit[j] for j in near), reverse=True)[:5]
        got = sorted((unit[i] @ unit[at[r]] for r in lists[rid[i]]), reverse=True)
        assert len(got) == len(set(lists[rid[i]])) >= len(want) and (np.array(got[: len(want)]) >= np.array(want) - 1e-12).all()


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_lists_of_all_curves_merge_in_order(size):
    rng = np.random.default_rng(6)
    rid = np.sort(rng.integers(0, 50, 200) * 3)
    lists = [sorted({(-float(rng.integers(0, 9)) / 8, int(m)) for m in rng.integers(0, 20, rng.integers(0, 9))}) for _ in rid]
    starts = np.r_[0, np.cumsum([len(x) for x in lists])]
    away, other = (np.array([e[c] for x in lists for e in x]) for c in (0, 1))
    batch = neighbours.list_batch(rid, starts, other, away)
    assert batch["rid"].to_pylist() == rid.tolist()
    parts = [batch.slice(s, size) for s in range(0, 200, size)]  # slices keep their offset into the buffers
    got = [r for b in neighbours.merge_batches(iter(parts), 5) for r in b.to_pylist()]
    want = {r: sorted({e for q, x in zip(rid, lists) if q == r for e in x})[:5] for r in rid.tolist()}
    assert [r["rid"] for r in got] == sorted(want)
    assert {r["rid"]: [(e["away"], e["other"]) for e in r["near"]] for r in got} == want
    assert list(neighbours.merge_batches(iter([]), 5)) == []


def test_lists_stay_packed_until_they_are_merged(spark):
    """One row object a list entry on the way to the merge was the larger part of the work around the products."""
    from siftwell.runtime import Workspace

    with Workspace(spark, "plan") as work:
        x = np.random.default_rng(8).normal(size=(300, 8)).astype(np.float32)
        df = work.save(spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "rid bigint, vec array<float>"))
        plan = neighbours.curve_lists(df, work, 10, 1.25, 1000, 6)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
    assert not any(x in plan for x in ("MapInPandas", "collect_list", "array_sort", "array_distinct"))


def brute(x, ids, k=10):
    s = x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None]
    np.fill_diagonal(s, -2)
    out = set()
    for i in range(len(x)):
        for j in np.lexsort((ids, -s[i].round(9)))[:k]:
            if j != i:
                out.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return out


def pairs(spark, x, ids, **options):
    df = spark.createDataFrame([(i, [float(v) for v in row], 1) for i, row in zip(ids, x)], "id string, vec array<float>, rid int")
    return {tuple(r) for r in neighbours.similar_pairs(df, **options).collect()}


@pytest.mark.parametrize("n", [2, 3, 11, 12])
def test_few_vectors(spark, n):
    x, ids = np.random.default_rng(n).normal(size=(n, 6)).astype(np.float32), [f"p{i:03d}" for i in range(n)]
    assert pairs(spark, x, ids) == brute(x.astype(float), ids)


def test_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24))
    x = (centres[rng.integers(0, 40, 4000)] + 0.8 * rng.normal(size=(4000, 24))).astype(np.float32)
    ids = [f"p{i:05d}" for i in rng.permutation(4000)]
    got, want = pairs(spark, x, ids, window_factor=0.75), brute(x.astype(float), ids)
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got)


def test_copies(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8)).astype(np.float32)
    x[20:40] = x[0]  # 21 equal vectors
    x[41] = x[40]
    ids = [f"p{i:03d}" for i in range(60)]
    assert pairs(spark, x, ids) == brute(x.astype(float), ids)


def test_a_third_of_all_rows_are_copies(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x[::3] = x[0]
    ids = [f"p{i:04d}" for i in range(900)]
    got, want = pairs(spark, x, ids), brute(x.astype(float), ids)
    assert len(got & want) >= 0.95 * len(want)


@pytest.mark.parametrize("norms", ["powers of two", "any"])
def test_a_third_of_all_rows_are_scaled_copies(spark, norms):
    rng = np.random.default_rng(15)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    scale = 2.0 ** rng.integers(-6, 7, 300) if norms == "powers of two" else rng.uniform(0.01, 50, 300)
    x[::3] = x[0] * scale[:, None]
    ids = [f"p{i:04d}" for i in rng.permutation(900)]
    got, want = pairs(spark, x, ids), brute(x.astype(float), ids)
    assert len(got & want) >= 0.97 * len(want) and len(got & want) >= 0.97 * len(got)


@pytest.mark.parametrize("noise", [1e-3, 0.2])
def test_a_third_of_all_rows_are_near_copies_of_one_vector(spark, noise):
    rng = np.random.default_rng(16)
    x = rng.normal(size=(3000, 64))
    x[::3] = (x[0] + noise * rng.normal(size=(1000, 64))) * rng.uniform(0.5, 2, (1000, 1))
    x, ids = x.astype(np.float32), [f"p{i:04d}" for i in rng.permutation(3000)]
    group = set(ids[::3])
    inside = lambda found: {p for p in found if group.issuperset(p)}
    want = x.astype(float)
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    s = want @ want.T
    np.fill_diagonal(s, -2)
    want = {tuple(sorted((ids[i], ids[j]))) for i in range(3000) for j in np.lexsort((ids, -s[i].round(13)))[:10]}
    got = inside(pairs(spark, x, ids))
    assert len(got & inside(want)) >= 0.99 * len(inside(want)) and len(got & inside(want)) >= 0.99 * len(got)


def test_no_vectors(spark):
    assert pairs(spark, np.zeros((0, 4)), []) == set()
    assert pairs(spark, np.ones((1, 4)), ["a"]) == set()


def table(spark, rows):
    schema = "idx bigint, id string, text_info struct<text:string,text_vector:array<float>>, vec string"
    return spark.createDataFrame([(i, p, None if v is None else ("t", v), "x") for i, p, v in rows], schema)


def test_usable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, "a", [1.0, 2.0]), (1, "a", [1.0, 2.0]), (2, "b", [0.0, 0.0]), (4, "c", [nan, 1.0]), (5, "d", [1.0]), (6, "e", None), (7, "f", [inf, 1.0]), (8, "g", [None, 1.0]), (9, None, [1.0, 1.0])]
    got = [(r["id"], r["arrived"], r["vec"]) for r in vectors.point_vectors(table(spark, rows), dim=2).collect()]
    assert got == [("a", 1, [1.0, 2.0])]


def greedy(x, least=0.9):
    s = x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None]
    case = np.zeros(len(x), bool)
    for i in range(len(x)):
        case[i] = ((s[i, :i] > least) & ~case[:i]).any()
    return set(np.flatnonzero(case).tolist())


def chained(n, dim=64, seed=7):
    """Chains of near-duplicates, copies among them, in mixed order."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        v = rng.normal(size=dim)
        for _ in range(rng.integers(1, 7)):
            rows.append(v * rng.uniform(0.5, 2))
            if rng.random() < 0.2:
                rows.append(rows[-1].copy())
            step = rng.normal(size=dim)
            v = v + step / np.linalg.norm(step) * np.linalg.norm(v) * rng.uniform(0.1, 0.42)
    x = np.array(rows[:n])[rng.permutation(n)].astype(np.float32)
    return x


def frame(spark, x, at=None):
    at = range(len(x)) if at is None else at
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(at, x)], "arrived bigint, vec array<float>")


def test_repeats_against_brute_force(spark):
    x = chained(600)
    got = {r["arrived"] for r in history.vector_repeats(frame(spark, x)).collect()}
    want = greedy(x.astype(float))
    assert len(want) > 100 and len(got ^ want) <= 0.01 * len(want)


def test_batches_equal_one_pass(spark, tmp_path):
    x = chained(150, seed=9)
    store, found = history.FingerprintHistory(spark, f"file://{tmp_path}/history", buckets=4), set()
    for at in np.array_split(np.arange(150), 3):
        found |= {r["arrived"] for r in store.process(frame(spark, x[at], at)).collect()}
    assert found == {r["arrived"] for r in history.vector_repeats(frame(spark, x)).collect()}


def test_reopened_history_goes_on(spark, tmp_path):
    x = np.random.default_rng(21).normal(size=(4, 64)).astype(np.float32)
    path = f"file://{tmp_path}/history"
    assert history.FingerprintHistory(spark, path, buckets=4).process(frame(spark, x, range(4))).count() == 0
    again = history.FingerprintHistory(spark, path, buckets=4).process(frame(spark, x[:3], range(4, 7)))
    assert {r["arrived"] for r in again.collect()} == {4, 5, 6}
    assert spark.read.parquet(f"{path}/vectors").count() == 4


def test_a_late_record_with_a_smaller_key_meets_the_history(spark, tmp_path):
    x = np.random.default_rng(22).normal(size=(3, 64)).astype(np.float32)
    store = history.FingerprintHistory(spark, f"file://{tmp_path}/late", buckets=4)
    assert store.process(frame(spark, x, [100, 101, 102])).count() == 0
    assert {r["arrived"] for r in store.process(frame(spark, x[:2] * 2, [1, 2])).collect()} == {1, 2}


def test_uncommitted_rows_are_not_read(spark, tmp_path):
    x = np.random.default_rng(23).normal(size=(3, 64)).astype(np.float32)
    path = f"file://{tmp_path}/broken"
    store = history.FingerprintHistory(spark, path, buckets=4)
    store.vectors.append(frame(spark, x), "lost")  # a job that failed before its commit
    store.blocks.append(history.block_rows(history.fingerprints(frame(spark, x)), "arrived"), "lost")
    again = history.FingerprintHistory(spark, path, buckets=4)
    assert again.process(frame(spark, x)).count() == 0
    assert {r["arrived"] for r in again.process(frame(spark, x, range(5, 8))).collect()} == {5, 6, 7}


def test_blocks_widen_with_the_history(spark, tmp_path):
    x = chained(90, seed=10)
    path, found = f"file://{tmp_path}/wide", set()
    for at in np.array_split(np.arange(90), 3):
        store = history.FingerprintHistory(spark, path, load=0.002, buckets=4)
        found |= {r["arrived"] for r in store.process(frame(spark, x[at], at)).collect()}
    assert found == {r["arrived"] for r in history.vector_repeats(frame(spark, x)).collect()}
    assert store.plan.bits > 12 and store.plan.tables > 30
    assert history.block_plan(10**9).words * 64 >= history.block_plan(10**9).tables * history.block_plan(10**9).bits


def test_stored_blocks_are_not_shuffled(spark, tmp_path):
    store = history.FingerprintHistory(spark, f"file://{tmp_path}/plan", buckets=4)
    x = np.random.default_rng(24).normal(size=(50, 64)).astype(np.float32)
    store.process(frame(spark, x))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = history.block_rows(history.fingerprints(frame(spark, x)), "arrived")
        pairs = history.block_matches(store.blocks.read(store.commits.batches()), new, "arrived", 100, ordered=False)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("hashpartitioning(block") == 1  # that of the new batch


def test_tables_by_batch_equal_one_pass(spark, tmp_path):
    from siftwell.runtime import read_table

    points, wrong = (read_table(spark, "/root/testdata/sf0.001", t).withColumn("batch_no", F.ceil(F.col("batch_no") / 6).cast("int")) for t in ("point_metadata", "wrong_ext"))
    got = {tuple(r) for r in history.repeats_by_batch(points, wrong, f"file://{tmp_path}/all").collect()}
    assert got == {tuple(r) for r in history.repeats_of_tables(points, wrong).collect()} and len(got) > 10


def test_only_earlier_accepted_records_count(spark):
    turn = lambda a: [float(np.cos(np.radians(a))), float(np.sin(np.radians(a))), *[0.0] * 62]
    got = {r["arrived"] for r in history.vector_repeats(frame(spark, [turn(0), turn(20), turn(40), turn(60)])).collect()}
    assert got == {1, 3}  # 2 matches only 1, which is a case; 3 matches 2


def test_copies_are_cases(spark):
    x = np.ones((300, 64), np.float32)
    x[:, 0] = np.where(np.arange(300) % 3 == 0, 1, -20)
    got = {r["arrived"] for r in history.vector_repeats(frame(spark, x)).collect()}
    assert got == set(range(300)) - {0, 1}


def test_no_history(spark):
    assert history.vector_repeats(frame(spark, np.zeros((0, 64)))).count() == 0


def test_path_repeats(spark):
    rows = [(5, 1, "a/x"), (5, 1, "a/x"), (2, 2, "./a/x"), (7, 1, "a/y"), (8, 1, None), (9, 1, "a//x"), (10, 3, "a/X")]
    df = spark.createDataFrame([(*r, "o") for r in rows], "row_id bigint, batch_no int, path string, object string")
    assert {r["row_id"] for r in history.path_repeats(df).collect()} == {2, 9}


def test_path_history(spark, tmp_path):
    df = lambda rows: spark.createDataFrame(rows, "row_id bigint, batch_no int, path string")
    store = lambda: history.PathHistory(spark, f"file://{tmp_path}/paths", buckets=4)
    assert {r["row_id"] for r in store().process(df([(1, 1, "a/x"), (2, 1, "./a/x"), (3, 1, None), (4, 1, "b")])).collect()} == {2}
    assert {r["row_id"] for r in store().process(df([(0, 2, "a//x"), (5, 2, "a/X"), (6, 2, "a/X")])).collect()} == {0, 6}
    assert store().process(df([])).count() == 0


def test_hamming_limit_keeps_near_pairs(spark):
    rng = np.random.default_rng(11)
    a = rng.normal(size=(400, 64))
    step = rng.normal(size=(400, 64))
    step -= (step * a).sum(1, keepdims=True) / (a * a).sum(1, keepdims=True) * a
    step *= np.linalg.norm(a, axis=1, keepdims=True) / np.linalg.norm(step, axis=1, keepdims=True)
    b = a + step * np.tan(np.arccos(0.93))
    prints = history.fingerprints(frame(spark, np.vstack([a, b])))
    found = history.block_matches(history.block_rows(prints.where("arrived < 400"), "arrived"), history.block_rows(prints.where("arrived >= 400"), "arrived"), "arrived", history.hamming_limit(0.9))
    assert found.where(F.col("later") == F.col("earlier") + 400).count() >= 0.985 * 400


def test_a_third_of_all_rows_are_near_copies(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(3000, 64))
    step = rng.normal(size=(1000, 64))
    x[::3] = x[0] + step / np.linalg.norm(step, axis=1, keepdims=True) * np.linalg.norm(x[0]) * rng.uniform(0.05, 0.3, (1000, 1))
    x = x.astype(np.float32)
    assert {r["arrived"] for r in history.vector_repeats(frame(spark, x)).collect()} == greedy(x.astype(float))
    prints = history.fingerprints(frame(spark, x))
    assert history.leader_pairs(prints, "arrived").count() <= 12 * 3000
