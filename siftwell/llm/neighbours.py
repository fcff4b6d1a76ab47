"""Most similar vectors of every vector by shifted Hilbert curves.

Vectors are projected to a few coordinates in several random rotations and shifts, and each is ordered
along a Hilbert curve. Every curve is cut into ranges; a task goes along a range and the window before and
after it, compares every vector with its window, and keeps the best. It holds some windows at a time, not the
range. The lists of all curves merge.

The projection is fitted on a bounded sample: it draws a vector towards the centres of the sample that
are near it and keeps the principal directions, so that vectors of one topic lie close on most curves.
The window grows with the power 2/3 of the number of vectors: in many dimensions a window of fixed size
loses neighbours as vectors are added, and the square root still lost some from 80 thousand vectors to
800 thousand. The work grows with the power 5/3, not 2.

Copies of one direction, at any norm, are ordered once. Groups of near-copies larger than the window are
found on the sample and compared exactly, every member with every other; that work is the square of the
group's size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.history import cosine
from siftwell.llm.vectors import hashed_sample, point_vectors
from siftwell.runtime import Workspace

_LEVELS = 127 * 258  # steps of the 16-bit coordinates that travel through the shuffle
_SAME = 1e-13  # cosines that differ by less are equal
_ENTRY = np.dtype([("away", "<f8"), ("other", "<i8")])  # of a list: minus the cosine, and the neighbour
_GROUP = 0.9  # least cosine of a near-copy to the centre of its group


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (n, dims) below 2**bits; dims * bits <= 64.

    The transform of axes to the transposed index follows Skilling (2004).
    """
    x = cells.astype(np.uint32).copy()
    n = x.shape[1]
    q = np.uint32(1 << (bits - 1))
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(n):
            on = (x[:, i] & q) != 0
            swap = np.where(on, np.uint32(0), (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(on, p, swap)
            if i:
                x[:, i] ^= swap
        q = np.uint32(q >> np.uint32(1))
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.uint32)
    q = np.uint32(1 << (bits - 1))
    while q > 1:
        t ^= np.where((x[:, n - 1] & q) != 0, np.uint32(q - 1), np.uint32(0))
        q = np.uint32(q >> np.uint32(1))
    x ^= t[:, None]
    key = np.zeros(len(x), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[:, i] >> np.uint32(bit)) & np.uint32(1)).astype(np.uint64)
    return key


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps extreme lengths from over- and underflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class CurveModel:
    """Projection and curves; ``keys`` gives one 63-bit key per curve, the low bits a hash that splits ties."""

    centres: np.ndarray
    mean: np.ndarray
    curves: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # projection, lowest, width of a cell
    sharpness: float
    residue: float
    bits: int

    def lift(self, unit: np.ndarray) -> np.ndarray:
        pull = self.sharpness * (unit @ self.centres.T)
        pull = np.exp(pull - pull.max(axis=1, keepdims=True))
        pull /= pull.sum(axis=1, keepdims=True)
        return pull @ self.centres + self.residue * unit - self.mean

    def keys(self, unit: np.ndarray, rid: np.ndarray) -> np.ndarray:
        lifted, top = self.lift(unit), (1 << self.bits) - 1
        out = np.empty((len(unit), len(self.curves)), np.int64)
        spare = 63 - self.bits * self.curves[0][0].shape[1]
        tie = (rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - spare)
        for c, (axes, low, step) in enumerate(self.curves):
            cells = np.clip((lifted @ axes - low) / step, 0, top).astype(np.uint32)
            out[:, c] = ((hilbert_index(cells, self.bits) << np.uint64(spare)) | tie).astype(np.int64)
        return out


def fit_curves(
    sample: np.ndarray, curves: int = 6, topics: int = 256, dims: int = 10, principal: int = 16, bits: int = 5,
    sharpness: float = 25.0, residue: float = 0.3, seed: int = 7,
) -> CurveModel:
    """Centres by spherical k-means, principal directions, and a random rotation and shift for each curve."""
    rng = np.random.default_rng(seed)
    x = _unit(sample.astype(np.float64))
    topics, dim = min(topics, len(x)), x.shape[1]
    centres = x[rng.choice(len(x), topics, replace=False)]
    for _ in range(12):
        nearest = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        empty = ~np.bincount(nearest, minlength=topics).astype(bool)
        sums[empty] = centres[empty]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    model = CurveModel(centres, np.zeros(dim), [], sharpness, residue, bits)
    lifted = model.lift(x)
    model.mean = lifted.mean(axis=0)
    lifted = lifted - model.mean
    principal, dims = min(principal, dim), min(dims, dim)
    directions = np.linalg.svd(lifted, full_matrices=False)[2][:principal] if len(x) > principal else np.eye(dim)[:principal]
    for _ in range(curves):
        turn = np.linalg.qr(rng.normal(size=(len(directions), len(directions))))[0][:, :dims]
        axes = directions.T @ turn
        seen = lifted @ axes
        spread = np.maximum(seen.std(axis=0), 1e-9)
        width = 10 * spread  # five deviations are covered, and as much again for the shift
        low = seen.mean(axis=0) - 2.5 * spread - rng.random(axes.shape[1]) * width / 2
        model.curves.append((axes, low, width / (1 << bits)))
    return model


def _pack16(unit: np.ndarray) -> np.ndarray:
    """Coordinates as 16-bit steps of the largest one; scaled copies give equal bytes."""
    return np.rint(unit / np.abs(unit).max(axis=1, keepdims=True) * _LEVELS).astype("<i2")


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary column of the items ``starts[i]..starts[i + 1]`` of contiguous data."""
    offsets = (starts * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data.view(np.uint8).reshape(-1))])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(starts, bytes) of a binary column without NULL."""
    offset = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    starts = np.frombuffer(column.buffers()[1], offset)[column.offset : column.offset + len(column) + 1]
    return starts - starts[0], np.frombuffer(column.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]


def _first_best(value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row; equal values, to 13 decimals, go by the earlier column."""
    k = min(k, value.shape[1])
    value = np.round(value, 13)
    kth = np.partition(value, value.shape[1] - k, axis=1)[:, value.shape[1] - k, None]
    above, equal = value > kth, value == kth
    return np.nonzero(above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= k - above.sum(axis=1, keepdims=True))))


def _hits(single: np.ndarray, unit: np.ndarray, rid: np.ndarray, s: int, e: int, lo: int, hi: int, k: int, bound: np.ndarray):
    """(row, column, product) of the entries of rows s..e against lo..hi that may be among the k best, and the raised bound."""
    product = single[s:e] @ single[lo:hi].T
    at = np.arange(max(s, lo), min(e, hi))
    product[at - s, at - lo] = -2
    width, few, row = min(16, (hi - lo) // (4 * k)), 64 * k * (e - s), None
    if width >= 2:  # every groups-th column is of one group; only groups that reach the bound are looked into
        groups = (hi - lo) // width
        grid = product[:, : width * groups].reshape(e - s, width, groups)
        most = grid.max(axis=1)
        bound = np.maximum(bound, np.partition(most, groups - k, axis=1)[:, groups - k])
        least = bound - 2e-6
        at, group = np.divmod(np.flatnonzero(most >= least[:, None]), groups)
        if len(at) <= few:
            inside, rest = grid[at, :, group] >= least[at, None], product[:, width * groups :] >= least[:, None]
            if np.count_nonzero(inside) + np.count_nonzero(rest) <= few:
                hot, place = np.divmod(np.flatnonzero(inside), width)
                rest_row, rest_col = np.nonzero(rest)
                row, col = np.r_[at[hot], rest_row], np.r_[place * groups + group[hot], rest_col + width * groups]
    else:
        if hi - lo > k:
            bound = np.maximum(bound, np.partition(product, hi - lo - k, axis=1)[:, hi - lo - k])
        hit = product >= (bound - 2e-6)[:, None]
        if np.count_nonzero(hit) <= few:
            row, col = np.divmod(np.flatnonzero(hit), hi - lo)
    if row is None:  # near-copies that single precision does not tell apart
        by_rid, parts = np.argsort(rid[lo:hi]), []
        for t in range(s, e, 64):
            f = min(t + 64, e)
            double = unit[t:f] @ unit[lo:hi].T
            at = np.arange(max(t, lo), min(f, hi))
            double[at - t, at - lo] = -2
            r, c = _first_best(double[:, by_rid], k)
            parts.append((r + t - s, by_rid[c]))
        row, col = (np.concatenate(x) for x in zip(*parts))
    return row + s, col + lo, product[row, col], bound


def window_best(
    unit: np.ndarray, rid: np.ndarray, own: np.ndarray, window: int, k: int, block: int = 512, tile: int = 16_384
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, neighbour, cosine) of the k best of each own row among ``window`` rows before and after it.

    A lower bound of the k-th best comes from the maxima of column groups, so only few entries of each
    product are looked at again, in double precision; equal cosines go by the smaller rid. Products are of
    ``block`` rows and ``tile`` columns at most, whatever the window.
    """
    n = len(unit)
    single = unit.astype(np.float32)
    left, right, value = [], [], []
    mine = np.flatnonzero(own)
    if not len(mine) or n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for s in range(mine[0], mine[-1] + 1, block):
        e = min(s + block, mine[-1] + 1)
        lo, hi = max(0, s - window), min(n, e + window)
        bound, parts = np.full(e - s, -1.5, np.float32), []
        for a in range(lo, hi, tile):
            *found, bound = _hits(single, unit, rid, s, e, a, min(a + tile, hi), k, bound)
            parts.append(found)
        row, col, product = (np.concatenate(x) for x in zip(*parts))
        kept = own[row] & (product > -1.5) & (product >= bound[row - s] - 2e-6)
        row, col = row[kept], col[kept]
        exact = np.einsum("ij,ij->i", unit[row], unit[col])
        order = np.lexsort((rid[col], -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, int)
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
        top = rank < k
        left.append(rid[row[top]])
        right.append(rid[col[top]])
        value.append(exact[top])
    return np.concatenate(left), np.concatenate(right), np.concatenate(value)


def list_frame(rid: np.ndarray, starts: np.ndarray, other: np.ndarray, away: np.ndarray) -> pd.DataFrame:
    """Lists ``starts[i]..starts[i + 1]`` of the entries, one a row."""
    return pd.DataFrame({"rid": rid, "other": np.split(other, starts[1:-1]), "away": np.split(away, starts[1:-1])})


def list_batch(rid: np.ndarray, starts: np.ndarray, other: np.ndarray, away: np.ndarray) -> pa.RecordBatch:
    """(rid, entries): the lists of ``list_frame`` as bytes of ``_ENTRY``."""
    entries = np.empty(len(other), _ENTRY)
    entries["away"], entries["other"] = away, other
    return pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), _binary(entries, starts)], ["rid", "entries"])


class Slide:
    """Rows of one cell in the order of their curve, of which about three windows are held at a time."""

    def __init__(self, window: int, k: int, made: Callable = list_frame):
        self.window, self.k, self.step, self.made = window, k, max(window, 4096), made
        self.start()

    def start(self) -> None:
        self.rid, self.own, self.packed, self.rows, self.done = [], [], [], 0, 0

    def add(self, rid: np.ndarray, own: np.ndarray, packed: np.ndarray) -> Iterator:
        self.rid.append(rid)
        self.own.append(own)
        self.packed.append(packed)
        self.rows += len(rid)
        if self.rows - self.done >= self.step + self.window:
            yield from self._lists(self.rows - self.window)

    def finish(self) -> Iterator:
        if self.rows > self.done:
            yield from self._lists(self.rows)
        self.start()

    def _lists(self, upto: int) -> Iterator:
        """The lists of the own rows from ``done`` to ``upto``; rows further back than a window are let go."""
        rid, own, packed = np.concatenate(self.rid), np.concatenate(self.own), np.concatenate(self.packed)
        unit = packed.astype(np.float64)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        now = own.copy()
        now[: self.done], now[upto:] = False, False
        q, other, cosine = window_best(unit, rid, now, self.window, self.k)
        gone = max(0, upto - self.window)
        self.rid, self.own, self.packed = [rid[gone:]], [own[gone:]], [packed[gone:]]
        self.rows, self.done = self.rows - gone, upto - gone
        if len(q):
            first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            yield self.made(q[first], np.r_[first, len(q)], other, -cosine)


def merged_lists(rid: np.ndarray, counts: np.ndarray, entries: np.ndarray, k: int) -> pa.RecordBatch:
    """(rid, near): the k best distinct entries of each rid; rid ascends, each row of it has ``counts`` entries."""
    first = np.r_[True, rid[1:] != rid[:-1]]
    owner = np.repeat(np.cumsum(first) - 1, counts)
    order = np.lexsort((entries["other"], entries["away"], owner))
    owner, entries = owner[order], entries[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (entries["other"][1:] != entries["other"][:-1]) | (entries["away"][1:] != entries["away"][:-1])
    owner, entries = owner[new], entries[new]
    top = np.arange(len(owner)) - np.searchsorted(owner, owner) < k
    owner, entries = owner[top], entries[top]
    near = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(entries[c])) for c in ("away", "other")], ["away", "other"])
    starts = np.searchsorted(owner, np.arange(np.count_nonzero(first) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(rid[first], pa.int64()), pa.ListArray.from_arrays(pa.array(starts), near)], ["rid", "near"])


def merge_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """merged_lists of (rid, entries) in the order of rid; the rows of one rid may lie in several batches."""
    rid, counts, entries = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _ENTRY)
    for batch in batches:
        if not batch.num_rows:
            continue
        starts, data = _bytes_of(batch["entries"])
        rid = np.r_[rid, batch["rid"].to_numpy()]
        counts = np.r_[counts, np.diff(starts) // _ENTRY.itemsize]
        entries = np.concatenate([entries, data.view(_ENTRY)])
        whole = np.searchsorted(rid, rid[-1])  # the last rid may go on
        if whole:
            cut = counts[:whole].sum()
            yield merged_lists(rid[:whole], counts[:whole], entries[:cut], k)
            rid, counts, entries = rid[whole:], counts[whole:], entries[cut:]
    if len(rid):
        yield merged_lists(rid, counts, entries, k)


def crowded_centres(sample: np.ndarray, share: float, rows: int = 4096) -> np.ndarray:
    """Centres of the groups of near-copies that hold more than half of ``share`` of the sample."""
    x = _unit(sample[:rows].astype(np.float64))
    near = ((x @ x.T) >= _GROUP).astype(np.float32)
    left, centres = np.ones(len(x), bool), []
    while True:
        held = near @ left.astype(np.float32) * left
        lead = int(held.argmax())
        if held[lead] < max(2, share * len(x) / 2):
            return np.array(centres).reshape(-1, x.shape[1])
        centre = x[(near[lead] > 0) & left].sum(axis=0)
        centres.append(centre / np.linalg.norm(centre))
        left &= x @ centres[-1] < _GROUP
        left[lead] = False


def _pair_best(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, neighbour, cosine) of the k best rows of b for each row of a; rb ascends."""
    parts = []
    for s in range(0, len(a), 128):
        product = a[s : s + 128] @ b.T
        product[ra[s : s + 128, None] == rb[None]] = -2
        width = len(b) // (4 * k)
        if width >= 2:
            best = product[:, : width * 4 * k].reshape(len(product), 4 * k, width).max(axis=2)
            hit = product >= np.partition(best, 3 * k, axis=1)[:, 3 * k, None] - _SAME
            few = np.count_nonzero(hit) <= 64 * k * len(product)
            row, col = np.nonzero(hit) if few else _first_best(product, k)
        else:
            row, col = _first_best(product, k)
        value = np.round(product[row, col], 13)
        order = np.lexsort((col, -value, row))
        row, col, value = row[order], col[order], value[order]
        first = np.searchsorted(row, row)
        top = (np.arange(len(row)) - first < k) & (value > -1.5)
        parts.append((ra[s + row[top]], rb[col[top]], value[top]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def crowded_lists(vectors: DataFrame, centres: np.ndarray, work: Workspace, k: int, block_rows: int = 32_768) -> tuple[DataFrame, DataFrame]:
    """(rid, groups) of the members of the groups around ``centres``, and (rid, away, other): their k best among these.

    Exact: blocks of a bounded size meet on a grid, each pair of blocks once.
    """
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if len(frame):
                row, group = np.nonzero(_unit(np.stack(frame["vec"].to_numpy()).astype(np.float64)) @ shared.value.T >= _GROUP)
                yield pd.DataFrame({"g": group.astype(np.int32), "rid": frame["rid"].to_numpy()[row], "vec": frame["vec"].to_numpy()[row]})

    kind = vectors.schema["vec"].dataType.simpleString()
    members = work.save(vectors.select("rid", "vec").mapInPandas(assign, f"g int, rid bigint, vec {kind}"))
    sizes = members.groupBy("g").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    placed = members.join(F.broadcast(sizes), "g").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = placed.select("g", "rid", "vec", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rid")
        low, high = frame["lo"].iloc[0], frame["hi"].iloc[0]
        unit, rid, block = _unit(np.stack(frame["vec"].to_numpy()).astype(np.float64)), frame["rid"].to_numpy(), frame["block"].to_numpy()
        a, b = block == low, block == high
        found = [_pair_best(unit[x], unit[y], rid[x], rid[y], k) for x, y in ([(a, b)] if low == high else [(a, b), (b, a)]) if x.any() and y.any()]
        q, other, value = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"rid": q, "away": -value, "other": other})

    lists = cells.groupBy("g", "lo", "hi").applyInPandas(best, "rid bigint, away double, other bigint")
    lists = lists.groupBy("rid", "other").agg(F.min("away").alias("away"))  # a pair may share several groups
    belongs = members.groupBy("rid").agg(F.collect_list("g").alias("groups"))
    return work.save(belongs), work.save(lists.select("rid", "away", "other"))


def _with_crowded(near: DataFrame, belongs: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """The lists ``near`` (rid, near) with the exact ones of the crowded groups in place of what they hold of these."""
    plain = near.join(belongs.select("rid"), "rid", "left_anti")
    entries = near.join(belongs, "rid").select("rid", "groups", F.explode("near").alias("e")).select("rid", "groups", "e.*")
    theirs = belongs.select(F.col("rid").alias("other"), F.col("groups").alias("held"))
    outside = entries.join(theirs, "other", "left").where(~F.coalesce(F.arrays_overlap("groups", "held"), F.lit(False)))
    both = outside.select("rid", "away", "other").unionByName(lists)
    made = both.groupBy("rid").agg(F.slice(F.array_sort(F.collect_list(F.struct("away", "other"))), 1, k).alias("near"))
    return plain.select("rid", "near").unionByName(made)


def curve_lists(vectors: DataFrame, work: Workspace, k: int, window_factor: float, sample_size: int, curves: int) -> DataFrame:
    """(rid, near): per vector of the saved table ``vectors`` (rid, vec) its k best as (minus cosine, rid), best first.

    The table is dropped once its keys and packed coordinates are written.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    sample = hashed_sample(vectors, "rid", sample_size, n).select("vec").toPandas()["vec"]
    schema = "rid bigint, near array<struct<away:double,other:bigint>>"
    if n < 2:
        return spark.createDataFrame([], schema)
    model = spark.sparkContext.broadcast(fit_curves(np.stack(sample.to_numpy()), curves=curves))
    names = [f"k{c}" for c in range(curves)]

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                unit = _unit(batch["vec"].flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64))
                packed = _pack16(unit)
                keys = model.value.keys(unit, batch["rid"].to_numpy())
                cells = _binary(packed.reshape(-1), np.arange(batch.num_rows + 1) * packed.shape[1])
                columns = [batch["rid"], cells, *(pa.array(np.ascontiguousarray(keys[:, c])) for c in range(curves))]
                yield pa.RecordBatch.from_arrays(columns, ["rid", "packed", *names])

    keyed = work.save(vectors.select("rid", "vec").mapInArrow(key, "rid bigint, packed binary, " + ", ".join(f"{c} bigint" for c in names)))

    window = math.ceil(window_factor * n ** (2 / 3))
    centres = crowded_centres(np.stack(sample.to_numpy()), window / n) if n > window else np.zeros((0, 0))
    crowded = crowded_lists(vectors, centres, work, k) if len(centres) else None
    work.drop(vectors)
    ranges = max(1, round(n / (8 * window)))
    accuracy = max(1000, math.ceil(5 * math.sqrt(n)))  # ranks within a small part of the window
    share = (window + n / accuracy + 64) / n
    cuts = np.arange(1, ranges) / ranges
    shares = np.clip(np.concatenate([cuts, cuts - share, cuts + share]), 0, 1).tolist()
    if ranges > 1:
        quantile = [F.percentile_approx(c, shares, accuracy).alias(c) for c in names]
        held = keyed.agg(*quantile).first()
        bounds = {c: np.array(held[c], np.int64).reshape(3, -1) for c in names}
    else:
        bounds = {c: np.zeros((3, 0), np.int64) for c in names}

    @F.arrow_udf("array<int>")
    def places(*keys: pa.Array) -> pa.Array:
        """Codes of the ranges a row goes to: (curve * ranges + range) * 2, plus 1 where it is the row's own."""
        rows, codes = [], []
        for c, series in enumerate(keys):
            value, (cut, before, after) = series.to_numpy(zero_copy_only=False), bounds[names[c]]
            home = np.searchsorted(cut, value, side="right")
            base = np.arange(len(value))
            rows.append(base)
            codes.append((c * ranges + home) * 2 + 1)
            # row r is in the margin of every range whose widened bounds hold it
            first = np.searchsorted(after, value, side="right")
            last = np.searchsorted(before, value, side="right")
            reach = int((last - first).max(initial=0))
            for step in range(reach + 1):
                target = first + step
                extra = (target <= last) & (target != home)
                rows.append(base[extra])
                codes.append((c * ranges + target[extra]) * 2)
        row, code = np.concatenate(rows), np.concatenate(codes)
        order = np.argsort(row, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(row, minlength=len(keys[0])))]
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(code[order], pa.int32()))

    placed = keyed.select("rid", "packed", F.array(*names).alias("keys"), F.explode(places(*names)).alias("code"))
    placed = placed.select(
        F.shiftright("code", 1).alias("cell"), F.col("code").bitwiseAND(1).alias("own"), "rid", "packed",
        F.element_at("keys", (F.floor(F.shiftright("code", 1) / ranges) + 1).cast("int")).alias("key"),
    )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slide, current = Slide(window, k, list_batch), None
        for batch in batches:
            cell, rid, own = (batch[c].to_numpy() for c in ("cell", "rid", "own"))
            bounds = np.r_[0, np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)] if len(cell) else [0]
            packed = _bytes_of(batch["packed"])[1].view("<i2").reshape(len(cell), -1) if len(cell) else None
            for a, b in zip(bounds[:-1], bounds[1:]):
                if cell[a] != current:
                    yield from slide.finish()
                    current = cell[a]
                yield from slide.add(rid[a:b], own[a:b] == 1, packed[a:b])
        yield from slide.finish()

    cells = curves * ranges
    # few cells share a partition; a task goes along its curve and holds some windows, never a whole cell
    spread = placed.repartition(4 * cells, "cell").sortWithinPartitions("cell", "key", "rid")
    lists = spread.select("cell", "own", "rid", "packed").mapInArrow(best, "rid bigint, entries binary")
    # a rid has a list a curve, so they are put in order and merged as they come
    ordered = lists.repartition("rid").sortWithinPartitions("rid")
    merged = ordered.mapInArrow(lambda batches: merge_batches(batches, k), schema)
    return _with_crowded(work.save(merged), *crowded, k) if crowded else merged


def similar_pairs(
    vectors: DataFrame, k: int = 10, curves: int = 6, window_factor: float = 1.25, sample_size: int = 16_384
) -> DataFrame:
    """Distinct (id_a, id_b), id_a < id_b, of which at least one is among the k most similar of the other.

    ``vectors`` has id (unique) and vec (equally long, finite, not all zero). Vectors of equal direction
    are compared once: the curves order one of each, and the k + 1 smallest ids of a group of copies stand
    for it in the lists, so a group of any size adds k pairs a member. A NULL id takes no part; fewer than
    two vectors give an empty result. Approximate: a neighbour outside all windows is missed.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "neighbours")
    known = vectors.where("id is not null and vec is not null").select("id", "vec")
    # numbers in the order of the ids, made in the job that sorts
    numbered = known.orderBy("id").select(F.monotonically_increasing_id().alias("n"), "id", "vec", _steps("vec").alias("steps"))
    points = work.save(numbered.select("n", "id", "vec", F.xxhash64("steps").alias("h"), F.hash("steps").alias("g")))
    alike = work.save(points.groupBy("h", "g").agg(F.min("n").alias("rid"), F.count("*").alias("members"), F.min_by("vec", "n").alias("vec")))
    copied = work.save(alike.where("members > 1").select("h", "g", F.col("rid").alias("lead"), F.col("vec").alias("lead_vec")))
    inside = None if copied.isEmpty() else _same_direction(points, copied, work)
    groups = alike.where("members = 1").select("rid", "vec")
    if inside is not None:
        groups = groups.unionByName(inside.where("n = rid").select("rid", "vec"))
    near = work.save(curve_lists(work.save(groups), work, k, window_factor, sample_size, curves))
    single = near.select(F.col("rid").alias("n"), F.explode("near.other").alias("m"))
    if inside is not None:
        single = _with_copies(inside.select("rid", "n"), near, work, k)
    pairs = single.select(F.least("n", "m").alias("a"), F.greatest("n", "m").alias("b")).distinct()
    names = points.select("n", "id")
    as_a, as_b = names.select(F.col("n").alias("a"), F.col("id").alias("id_a")), names.select(F.col("n").alias("b"), F.col("id").alias("id_b"))
    return pairs.join(as_a, "a").join(as_b, "b").select("id_a", "id_b")


def _steps(vec: str) -> Column:
    """Coordinates as steps of 1/4096 of the largest one: equal for copies at any norm but those on the edge of a step."""
    top = F.array(F.array_max(F.transform(vec, F.abs)).cast("double"))  # bound by a lambda, so taken once a row
    return F.element_at(F.transform(top, lambda t: F.transform(vec, lambda x: F.rint(x.cast("double") / t * 4096).cast("int"))), 1)


def _same_direction(points: DataFrame, copied: DataFrame, work: Workspace) -> DataFrame:
    """(n, rid, vec) of the points with equal steps; rid is the first point of the same direction.

    A point whose cosine to the first with its steps is 1 goes with it, others go with their equals only.
    """
    same = cosine(F.col("vec"), F.col("lead_vec")) >= 1 - _SAME
    placed = work.save(points.join(copied, ["h", "g"]).select("n", "vec", F.when(same, F.col("lead")).alias("lead")))
    apart = placed.where("lead is null").select("n", "vec")
    firsts = apart.groupBy("vec").agg(F.min("n").alias("rid"))
    own = placed.where("lead is not null").select("n", F.col("lead").alias("rid"), "vec")
    return work.save(own.unionByName(apart.join(firsts, "vec").select("n", "rid", "vec")))


def _with_copies(inside: DataFrame, near: DataFrame, work: Workspace, k: int) -> DataFrame:
    """(n, m): the k best of every point where ``inside`` (rid, n) has the members of directions that may occur more than once.

    Only lists that hold a copied vector, or belong to one, are made again.
    """
    from pyspark.sql import Window

    by_number = Window.partitionBy("rid").orderBy("n")
    few = inside.withColumn("at", F.row_number().over(by_number)).where(F.col("at") <= k + 1)
    few = work.save(few.groupBy("rid").agg(F.sort_array(F.collect_list("n")).alias("numbers")))
    entries = near.select("rid", F.explode("near").alias("e")).select("rid", "e.away", "e.other")
    filled = entries.join(few.select(F.col("rid").alias("other"), "numbers"), "other", "left")
    touched = filled.where("numbers is not null").select("rid").unionByName(few.select("rid")).distinct()
    touched = work.save(touched)
    plain = entries.join(touched, "rid", "left_anti").select(F.col("rid").alias("n"), F.col("other").alias("m"))
    again = filled.join(touched, "rid", "left_semi").select(
        "rid", "away", F.explode(F.coalesce("numbers", F.array("other"))).alias("m")
    )
    self_lists = few.select("rid", F.lit(-2.0).alias("away"), F.explode("numbers").alias("m"))
    ranked = again.unionByName(self_lists).groupBy("rid").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("away", "m"))), 1, k + 1).alias("best")
    )
    members = inside.unionByName(touched.join(few, "rid", "left_anti").select("rid", F.col("rid").alias("n")))
    own = members.join(ranked, "rid").select(
        "n", F.slice(F.filter("best.m", lambda m: m != F.col("n")), 1, k).alias("ms")
    )
    return plain.unionByName(own.select("n", F.explode("ms").alias("m")))


def point_neighbours(points: DataFrame, **options) -> DataFrame:
    """similar_pairs over the usable vectors of all points, deleted ones too."""
    return similar_pairs(point_vectors(points).select("id", "vec"), **options)
