"""Density clustering: DBSCAN on pair tables, HDBSCAN over a spanning tree of all pairs, OPTICS on bounded samples."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.operators.components import star_components
from siftwell.operators.knn import _distances, _matrix
from siftwell.operators.similarity import similar_pairs
from siftwell.runtime import Workspace


def dbscan(vectors: DataFrame, key: str, vec: str, eps: float = 0.015, min_points: int = 2, **options) -> DataFrame:
    """(key, cluster_id, role) with role in core, border, noise; distance is 1 - cosine, eps inclusive.

    A point with ``min_points`` points within eps, itself included, is core. cluster_id is the least core of
    the cluster; a border point joins the least cluster with a core in reach, noise has NULL. Zero vectors
    are noise.
    """
    work = Workspace(vectors.sparkSession, "dbscan")
    pairs = work.save(similar_pairs(vectors, key, vec, 1 - eps, **options).select("a", "b"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nodes = vectors.select(F.col(key).alias("x")).where("x is not null").distinct()
    degrees = both.groupBy(F.col("a").alias("x")).agg(F.count("*").alias("n"))
    core = work.save(nodes.join(degrees, "x", "left").where(F.coalesce("n", F.lit(0)) + 1 >= min_points).select("x"))
    core_a, core_b = core.withColumnRenamed("x", "a"), core.withColumnRenamed("x", "b")
    inner = pairs.join(core_a, "a", "left_semi").join(core_b, "b", "left_semi")
    roots = star_components(inner.select(F.col("a").alias("u"), F.col("b").alias("v")), work)
    labels = work.save(core.join(roots, "x", "left").select("x", F.coalesce("root", "x").alias("cluster_id")))
    reach = both.join(labels.withColumnRenamed("x", "b"), "b").groupBy(F.col("a").alias("x")).agg(F.min("cluster_id").alias("near"))
    out = nodes.join(labels, "x", "left").join(reach, "x", "left")
    role = F.when(F.col("cluster_id").isNotNull(), F.lit("core")).when(F.col("near").isNotNull(), F.lit("border")).otherwise(F.lit("noise"))
    return out.select(F.col("x").alias(key), F.coalesce("cluster_id", "near").alias("cluster_id"), role.alias("role"))


def minimum_spanning_forest(edges: DataFrame, work: Workspace) -> DataFrame:
    """(a, b, w): Boruvka's rounds over edges (a, b, w); every round at least halves the number of trees.

    Each tree takes its lightest outgoing edge (ties by ends), trees so joined get one label by star
    contraction, and edges inside a tree drop out.
    """
    left = work.save(edges.select("a", "b", "w", F.col("a").alias("ta"), F.col("b").alias("tb")))
    chosen: DataFrame | None = None
    while not left.isEmpty():
        ends = left.select("ta", F.struct("w", "a", "b", "ta", "tb").alias("e")).unionByName(left.select(F.col("tb").alias("ta"), F.struct("w", "a", "b", "ta", "tb").alias("e")))
        best = work.save(ends.groupBy("ta").agg(F.min("e").alias("e")).select("e.*").distinct())
        picked = best.select("a", "b", "w")
        chosen = picked if chosen is None else chosen.unionByName(picked)
        roots = work.save(star_components(best.select(F.col("ta").alias("u"), F.col("tb").alias("v")), work))
        to = lambda c: roots.select(F.col("x").alias(c), F.col("root").alias(f"n{c}"))
        moved = left.join(to("ta"), "ta", "left").join(to("tb"), "tb", "left")
        moved = moved.select("a", "b", "w", F.coalesce("nta", "ta").alias("ta"), F.coalesce("ntb", "tb").alias("tb")).where("ta <> tb")
        # one edge between two trees is enough
        pair = [F.least("ta", "tb").alias("ta"), F.greatest("ta", "tb").alias("tb")]
        after = work.save(moved.groupBy(*pair).agg(F.min(F.struct("w", "a", "b")).alias("e")).select("e.a", "e.b", "e.w", "ta", "tb"))
        work.drop(left)
        left = after
    return edges.select("a", "b", "w").limit(0) if chosen is None else chosen.distinct()


def condense(edges: pd.DataFrame, nodes: list, min_size: int) -> dict:
    """Node -> label (least member) by excess of mass over the hierarchy of one spanning tree.

    Edges are taken in order of weight. A component becomes a cluster when it reaches ``min_size``; where
    two clusters meet, each is settled as itself or as the best of what it was made of, by stability, the
    sum over its points of the density at which they leave less that at which the cluster ends. The whole
    tree may be one cluster, for it is a component of its own.
    """
    parent, size = {x: x for x in nodes}, dict.fromkeys(nodes, 1)
    joined = {x: (x,) for x in nodes}  # root -> nested pairs of what it was made of, read out once at the end
    state: dict = {}  # root -> [sum of leaving densities, stability below, nested pairs of groups below]

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def settle(root, density):
        total, below, groups = state[root]
        own = total - density * size[root]
        return (below, groups) if below > own else (own, [joined[root]])

    for a, b, w in edges.sort_values(["w", "a", "b"])[["a", "b", "w"]].itertuples(index=False):
        ra, rb = find(a), find(b)
        if ra == rb:
            continue
        if size[ra] < size[rb]:
            ra, rb = rb, ra
        density = min(1 / w if w > 0 else np.inf, 1e12)
        big = [r for r in (ra, rb) if r in state]
        if len(big) == 2:
            (low, first), (high, second) = settle(ra, density), settle(rb, density)
            new = [density * (size[ra] + size[rb]), low + high, (first, second)]
        elif big:
            small = rb if big[0] == ra else ra
            total, below, groups = state[big[0]]
            new = [total + density * size[small], below, groups]
        else:
            both = size[ra] + size[rb]
            new = [density * both, 0.0, ()] if both >= min_size else None
        parent[rb] = ra
        size[ra] += size.pop(rb)
        joined[ra] = (joined[ra], joined.pop(rb))
        state.pop(rb, None)
        if new:
            state[ra] = new
    labels: dict = {}
    open_groups = [settle(root, 0.0)[1] for root in state]
    while open_groups:
        groups = open_groups.pop()
        if isinstance(groups, tuple):
            open_groups.extend(groups)
            continue
        group, parts = [], list(groups)
        while parts:
            part = parts.pop()
            if len(part) == 1:
                group.append(part[0])
            else:
                parts.extend(part)
        labels.update(dict.fromkeys(group, min(group)))
    return labels


def _grid(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` (key, ...) in the cells (lo, hi) of a grid of blocks, each pair of blocks one cell."""
    blocks = max(1, math.ceil(rows.count() / block_rows))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return placed.select(*rows.columns, "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))


def _unit_rows(values: pd.Series) -> np.ndarray:
    x = np.stack(values.to_numpy()).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _gaps(a: np.ndarray, b: np.ndarray, same: bool) -> np.ndarray:
    """Euclidean distances of unit vectors; infinite from a row to itself."""
    d = np.sqrt(np.maximum(2 - 2 * a @ b.T, 0))
    if same:
        np.fill_diagonal(d, np.inf)
    return d


def _cell_cores(n: int):
    """Per row of a cell the ``n`` least distances to rows of the other block."""

    def kernel(frame: pd.DataFrame) -> pd.DataFrame:
        low, high = frame["lo"].iloc[0], frame["hi"].iloc[0]
        a, b = frame[frame["block"] == low], frame[frame["block"] == high]
        parts = []
        if len(a) and len(b):
            d = _gaps(_unit_rows(a["vec"]), _unit_rows(b["vec"]), low == high)
            for keys, x in [(a["key"], d)] + ([(b["key"], d.T)] if low != high else []):
                k = min(n, x.shape[1])
                least = np.partition(x, k - 1, axis=1)[:, :k]
                parts.append(pd.DataFrame({"key": np.repeat(keys.to_numpy(), k), "d": least.ravel()}))
        out = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"key": frame["key"].iloc[:0], "d": np.zeros(0)})
        return out[np.isfinite(out["d"])]

    return kernel


def _cell_forest(frame: pd.DataFrame) -> pd.DataFrame:
    """(a, b, w): the minimum spanning tree of mutual reachability over a cell's pairs, by Prim's algorithm.

    Of a cell of two blocks only the pairs between them count. An edge that is in no tree of its cell is the
    heaviest of a cycle and in no tree of the whole.
    """
    low, high = frame["lo"].iloc[0], frame["hi"].iloc[0]
    frame = frame.sort_values("key", ignore_index=True)
    key, core, block = frame["key"].to_numpy(), frame["core"].to_numpy(), frame["block"].to_numpy()
    unit, n = _unit_rows(frame["vec"]), len(frame)
    if n < 2 or (low != high and (block == block[0]).all()):
        return pd.DataFrame({"a": key[:0], "b": key[:0], "w": np.zeros(0)})
    reach, source, out = np.full(n, np.inf), np.zeros(n, int), np.ones(n, bool)
    ends, weight, at = [], [], 0
    for _ in range(n - 1):
        out[at] = False
        w = np.maximum(np.sqrt(np.maximum(2 - 2 * unit @ unit[at], 0)), np.maximum(core, core[at]))
        nearer = out & (w < reach)
        if low != high:
            nearer &= block != block[at]
        reach[nearer], source[nearer] = w[nearer], at
        at = int(np.where(out, reach, np.inf).argmin())
        ends.append((source[at], at))
        weight.append(reach[at])
    i, j = np.array(ends).T
    return pd.DataFrame({"a": key[np.minimum(i, j)], "b": key[np.maximum(i, j)], "w": weight})


def hdbscan(
    vectors: DataFrame, key: str, vec: str, max_distance: float | None = None, min_samples: int = 2, min_size: int = 2,
    max_component: int | None = None, block_rows: int = 2048,
) -> DataFrame:
    """(key, cluster_id): HDBSCAN on Euclidean distances of unit vectors; noise has NULL.

    The spanning tree of mutual reachability is that over all pairs, or those up to ``max_distance`` if one is
    given: cells of a grid of blocks keep the edges of their own spanning trees, and the rounds in Spark join
    these to one tree. Every tree is condensed on its own in one task, whose memory follows the tree; a ``max_component`` bounds it.
    The core distance is that to the ``min_samples``-th point, the point itself included. Zero, NULL and NaN
    vectors are noise.
    """
    work = Workspace(vectors.sparkSession, "hdbscan")
    rows = vectors.select(F.col(key).alias("key"), F.col(vec).alias("vec")).where("key is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = work.save(rows.where(finite & F.exists("vec", lambda x: x != 0)))
    kind = rows.schema["key"].dataType.simpleString()
    nth = max(min_samples - 1, 1)
    least = _grid(rows, block_rows).groupBy("lo", "hi").applyInPandas(_cell_cores(nth), f"key {kind}, d double")
    core = least.groupBy("key").agg(F.sort_array(F.collect_list("d")).alias("d")).where(F.size("d") >= nth)
    core = work.save(core.select("key", F.element_at("d", nth).alias("core")))
    edges = _grid(work.save(rows.join(core, "key")), block_rows).groupBy("lo", "hi").applyInPandas(_cell_forest, f"a {kind}, b {kind}, w double")
    if max_distance is not None:
        edges = edges.where(F.col("w") <= max_distance)
    forest = work.save(minimum_spanning_forest(work.save(edges), work))
    roots = star_components(forest.select(F.col("a").alias("u"), F.col("b").alias("v")), work)
    trees = forest.join(roots.withColumnRenamed("x", "a"), "a").select("root", "a", "b", "w")

    def tree(frame: pd.DataFrame) -> pd.DataFrame:
        if max_component is not None and len(frame) >= max_component:
            raise ValueError(f"a component of more than {max_component} points; give a max_distance")
        labels = condense(frame, sorted(set(frame["a"]) | set(frame["b"])), min_size)
        return pd.DataFrame({"key": list(labels), "cluster_id": list(labels.values())}) if labels else pd.DataFrame({"key": frame["a"].iloc[:0], "cluster_id": frame["a"].iloc[:0]})

    found = trees.groupBy("root").applyInPandas(tree, f"key {kind}, cluster_id {kind}")
    return vectors.select(F.col(key).alias("key")).where("key is not null").distinct().join(found, "key", "left").select(F.col("key").alias(key), "cluster_id")


def optics_order(distance: np.ndarray, eps: float, min_points: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, reachability) of a distance matrix; ties go to the lower index."""
    n = len(distance)
    inside = distance <= eps
    core = np.where(inside.sum(1) >= min_points, np.sort(distance, axis=1)[:, min(min_points, n) - 1] if n else 0, np.inf)
    reach, done, order = np.full(n, np.inf), np.zeros(n, bool), []
    for start in range(n):
        if done[start]:
            continue
        current = start
        while current >= 0:
            done[current] = True
            order.append(current)
            if np.isfinite(core[current]):
                near = inside[current] & ~done
                reach[near] = np.minimum(reach[near], np.maximum(core[current], distance[current, near]))
            open_ = np.where(done, np.inf, reach)
            current = int(open_.argmin()) if np.isfinite(open_.min(initial=np.inf)) else -1
    return np.array(order, int), reach[np.array(order, int)] if n else reach


def optics(sample: DataFrame, key: str, vec: str, eps: float = 10.0, min_points: int = 2, metric: str = "hamming_bytes", max_rows: int = 20_000) -> DataFrame:
    """(key, position, reachability, cluster_id) of a bounded sample in the order of OPTICS; noise has NULL.

    A cluster is a stretch of the order whose reachability stays within eps; its id is the least key. The
    sample is handled in one task; more than ``max_rows`` rows are an error. Reachability is NULL at the
    start of a stretch.
    """
    rows = sample.select(F.col(key).alias("key"), F.col(vec).alias("vec")).where("key is not null and vec is not null")
    kind = rows.schema["key"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) > max_rows:
            raise ValueError(f"more than {max_rows} rows")
        frame = frame.sort_values("key", ignore_index=True)
        x = _matrix(frame["vec"], metric)
        distance = _distances(x, x, metric)
        order, reach = optics_order(distance, eps, min_points)
        keys = frame["key"].to_numpy()[order]
        stretch = np.cumsum(~np.isfinite(reach))
        out = pd.DataFrame({"key": keys, "position": np.arange(len(keys)), "reachability": reach, "stretch": stretch})
        size = out.groupby("stretch")["key"].transform("size")
        out["cluster_id"] = out.groupby("stretch")["key"].transform("min").where(size >= min_points, None)
        out["reachability"] = out["reachability"].where(np.isfinite(out["reachability"]), None)
        return out[["key", "position", "reachability", "cluster_id"]]

    found = rows.groupBy().applyInPandas(run, f"key {kind}, position int, reachability double, cluster_id {kind}")
    return found.withColumnRenamed("key", key)


def seeded_sample(rows: DataFrame, key: str, seeds: DataFrame, size: int, seed: int) -> DataFrame:
    """The rows of the ``seeds`` (key) that exist, then ``size`` others in the order of a seeded hash of the key."""
    fixed = rows.join(seeds.select(key).distinct(), key, "left_semi")
    others = rows.join(seeds.select(key).distinct(), key, "left_anti").orderBy(F.md5(F.concat_ws("/", F.lit(seed), F.col(key).cast("string"))), key).limit(size)
    return fixed.withColumn("is_seed", F.lit(True)).unionByName(others.withColumn("is_seed", F.lit(False)))
