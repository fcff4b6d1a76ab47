"""Greedy complete-link clustering, first fit, in a pinned order.

A record joins the first cluster all of whose members are similar to it. Joining needs an edge to every
member, so clusters never reach over the connected components of the similarity graph: pairs are found
first, and each component is folded on its own, with its edges only. Most components are a few records, so
a group of many goes to Python at once. Where groups are given, those of bounded size are compared and
folded whole in one pass instead, and only larger ones go by their components.
"""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.vectors import dot, norm
from siftwell.operators.components import star_components
from siftwell.operators.similarity import IMAGE_THRESHOLD, similar_pairs
from siftwell.runtime import Workspace

#: Records a chunk of the chunked variant (fixed value).
CHUNK_ROWS = 20_000
#: Edges of the components that are handed over together, on average.
_EDGES_A_GROUP = 20_000
#: Records with a usable vector up to which a given group is compared and folded in one pass.
_GROUP_ROWS = 2_000
#: Records of such groups that are handed over together, on average, and pairs of them that are compared at once.
_ROWS_A_PART, _PAIRS_AT_ONCE = 4_000, 1 << 18


def _first_fit(keys: list, near: dict) -> list[list]:
    clusters: list[list] = []
    place: dict = {}
    for key in keys:
        friends = near.get(key, frozenset())
        for at in sorted({place[f] for f in friends if f in place}):  # any other cluster holds strangers only
            if friends.issuperset(clusters[at]):
                break
        else:
            at = len(clusters)
            clusters.append([])
        clusters[at].append(key)
        place[key] = at
    return clusters


def _merge(local: list[list], merged: list[list], near: dict) -> list[list]:
    for cluster in local:
        for other in merged:
            if all(b in near.get(a, frozenset()) for a in cluster for b in other):
                other.extend(cluster)
                break
        else:
            merged.append(list(cluster))
    return merged


def _fold(members: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """(key, first) of the members of any number of components, given with all their edges."""
    near: dict = {}
    for a, b in zip(edges["a"], edges["b"]):
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    members = members[members["chunk"].notna()].sort_values(["root", "at", "key"])
    found = []
    for _, component in groupby(zip(members["root"], members["chunk"], members["key"]), itemgetter(0)):
        merged: list[list] = []
        for _, chunk in groupby(component, itemgetter(1)):
            merged = _merge(_first_fit([key for _, _, key in chunk], near), merged, near)
        found += [(k, c[0]) for c in merged for k in c]
    return pd.DataFrame(found, columns=["key", "first"])


def _near_pairs(v: np.ndarray, n: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs within starts..ends with a cosine above ``least``; sums go as in ``dot``, and NaN is above as in SQL."""
    columns = np.ascontiguousarray(v.T)
    found = [(np.array([], int), np.array([], int))]

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        for k in range(0, len(a), _PAIRS_AT_ONCE):
            i, j = a[k : k + _PAIRS_AT_ONCE], b[k : k + _PAIRS_AT_ONCE]
            total = np.zeros(len(i))
            with np.errstate(invalid="ignore", over="ignore"):
                for column in columns:
                    total += column[i] * column[j]
                above = ~(total / (n[i] * n[j]) <= least)
            found.append((i[above], j[above]))

    held, waiting = [], 0
    for start, end in zip(starts, ends):
        i, j = np.triu_indices(end - start, 1)
        held.append((i + start, j + start))
        waiting += len(i)
        if waiting >= _PAIRS_AT_ONCE or end == ends[-1]:
            compare(*map(np.concatenate, zip(*held)))
            held, waiting = [], 0
    a, b = map(np.concatenate, zip(*found))
    return a, b


def _link_groups(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """(key, first) of the members of whole groups, given as g, key, at, n, v; v is NULL where it resembles nothing."""
    usable = rows[rows["v"].notna()].sort_values(["g", "at", "key"])
    usable = usable.assign(length=usable["v"].map(len))
    if len(usable) and usable.groupby("g")["length"].nunique().max() > 1:
        raise ValueError("vectors of unequal length")
    firsts: dict = {}
    for _, part in usable.groupby("length"):
        keys, g = part["key"].to_numpy(object), part["g"].to_numpy(object)
        starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        ends = np.append(starts[1:], len(g))
        a, b = _near_pairs(np.stack(part["v"]).astype(np.float64), part["n"].to_numpy(np.float64), starts, ends, least)
        near: dict = {}
        for x, y in zip(keys[a], keys[b]):
            near.setdefault(x, set()).add(y)
            near.setdefault(y, set()).add(x)
        for start, end in zip(starts, ends):
            for cluster in _first_fit([key for key in keys[start:end] if key in near], near):
                firsts.update(dict.fromkeys(cluster, cluster[0]))
    return pd.DataFrame({"key": rows["key"], "first": [firsts.get(key, key) for key in rows["key"]]})


def pairs_in_groups(rows: DataFrame, group: str, key: str, vec: str, least: float) -> DataFrame:
    """(a, b) of the same group, a < b, with a cosine above ``least``; lengths are computed once a row."""
    side = rows.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(vec).alias("v"), norm(F.col(vec)).alias("n")).where("n > 0")
    on = (F.col("l.g") == F.col("r.g")) & (F.col("l.k") < F.col("r.k"))
    near = side.alias("l").join(side.alias("r"), on).where(dot(F.col("l.v"), F.col("r.v")) / (F.col("l.n") * F.col("r.n")) > least)
    return near.select(F.col("l.k").alias("a"), F.col("r.k").alias("b"))


def complete_link(
    vectors: DataFrame, key: str, vec: str, least: float = IMAGE_THRESHOLD, group: str | None = None,
    order: str | None = None, chunk_rows: int | None = None,
) -> DataFrame:
    """(key, cluster_id): cluster_id is the first member's key; similarity must be above ``least``.

    Records come in the order of ``order`` (the key if None), ties by key. With ``group`` only records of
    one group join; keys must then be unique over all groups. With ``chunk_rows`` every chunk of so many
    records (by ``order``, a dense index) is clustered alone, and whole clusters then join the first
    earlier cluster to all of whose members all of theirs are similar. Records with a zero or NULL vector
    stay alone.
    """
    if not group or chunk_rows:
        return _link_by_components(vectors, key, vec, least, group, order, chunk_rows)
    rows = vectors.where(F.col(key).isNotNull()).select(F.col(group).alias("g"), F.col(key).alias("key"), F.col(order or key).alias("at"), F.col(vec).alias("v"), norm(F.col(vec)).alias("n"))
    usable = F.col("g").isNotNull() & F.coalesce(F.col("n") > 0, F.lit(False))
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.count_if(usable).alias("usable"))
    total, most = sizes.agg(F.sum("rows"), F.max("usable")).first()
    linked = None
    if (most or 0) > _GROUP_ROWS:
        large = sizes.where(F.col("usable") > _GROUP_ROWS).select("g")
        linked = _link_by_components(vectors.join(large.withColumnRenamed("g", group), group, "left_semi"), key, vec, least, group, order, None)
        rows = rows.join(large, "g", "left_anti")
    spread = F.pmod(F.when(usable, F.xxhash64("g")).otherwise(F.xxhash64("key")), F.lit((total or 0) // _ROWS_A_PART + 1))
    kind = vectors.schema[key].dataType.simpleString()
    parts = rows.select("g", "key", "at", "n", F.when(usable, F.col("v")).alias("v"), spread.alias("part")).groupBy("part")
    folded = parts.applyInPandas(lambda part: _link_groups(part, least), f"key {kind}, first {kind}")
    whole = folded.select(F.col("key").alias(key), F.col("first").alias("cluster_id"))
    return whole if linked is None else whole.unionByName(linked)


def _link_by_components(vectors: DataFrame, key: str, vec: str, least: float, group: str | None, order: str | None, chunk_rows: int | None) -> DataFrame:
    work = Workspace(vectors.sparkSession, "links")
    at = F.col(order or key)
    chunk = F.floor(at / chunk_rows) if chunk_rows else F.lit(0)
    rows = vectors.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), at.alias("at"), chunk.cast("bigint").alias("chunk"))
    found = pairs_in_groups(vectors, group, key, vec, least) if group else similar_pairs(vectors, key, vec, least, strict=True)
    edges = work.save(found.select("a", "b"), rows=F.count(F.lit(1)))
    roots = work.save(star_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), work))
    members = rows.join(roots.withColumnRenamed("x", "key"), "key")
    linked = edges.join(roots.select(F.col("x").alias("a"), F.col("root").alias("tree")), "a").select("a", "b", "tree")
    kind = vectors.schema[key].dataType.simpleString()
    groups = work.metric(edges) // _EDGES_A_GROUP + 1
    of = lambda root: F.pmod(F.xxhash64(root), F.lit(groups)).alias("part")
    folded = members.groupBy(of("root")).cogroup(linked.groupBy(of("tree"))).applyInPandas(_fold, f"key {kind}, first {kind}")
    return rows.join(folded, "key", "left").select(F.col("key").alias(key), F.coalesce("first", "key").alias("cluster_id"))
