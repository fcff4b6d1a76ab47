"""Reduction of vectors to few dimensions that keeps near, mid-near and far pairs (PaCMAP)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Settings of the embedding (fixed values).
DIMENSIONS, NEIGHBOURS, MID_RATIO, FAR_RATIO, LEARNING_RATE, PHASES = 10, 15, 0.5, 2.0, 1.0, (200, 200, 500)


def _phase_weights(step: int, phases: tuple[int, int, int]) -> tuple[float, float, float]:
    """Weights of near, mid-near and far pairs, after Wang et al. (2021)."""
    if step < phases[0]:
        return 2.0, 1000 + (3 - 1000) * step / phases[0], 1.0
    if step < phases[0] + phases[1]:
        return 3.0, 3.0, 1.0
    return 1.0, 0.0, 1.0


def embed(
    x: np.ndarray, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS, phases: tuple[int, int, int] = PHASES,
    rate: float = LEARNING_RATE, seed: int = 20, snapshots: tuple[int, ...] = (),
) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Embedding of the rows of x by Adam on the three kinds of pairs, started from principal components."""
    rng, n = np.random.default_rng(seed), len(x)
    if n < 3:
        return np.zeros((n, dimensions)), {}
    x = x - x.mean(axis=0)
    square = (x * x).sum(1)
    gap = np.maximum(square[:, None] + square[None] - 2 * x @ x.T, 0)
    np.fill_diagonal(gap, np.inf)
    k = min(neighbours, n - 1)
    order = np.argsort(gap, axis=1, kind="stable")
    scale = np.sqrt(np.maximum(np.take_along_axis(gap, order[:, min(3, n - 2) : min(6, n - 1)], axis=1).mean(axis=1), 1e-12))
    scaled = np.argsort(gap / (scale[:, None] * scale[None]), axis=1, kind="stable")
    mid, far = max(1, round(k * MID_RATIO)), max(1, round(k * FAR_RATIO))
    rows = np.arange(n)
    near_pairs = np.stack([np.repeat(rows, k), scaled[:, :k].ravel()])
    six = rng.integers(0, n, (n, mid, 6))
    second = np.argsort(gap[rows[:, None, None], six], axis=2, kind="stable")[:, :, 1]
    mid_pairs = np.stack([np.repeat(rows, mid), np.take_along_axis(six, second[:, :, None], axis=2).ravel()])
    far_pairs = np.stack([np.repeat(rows, far), order[rows[:, None], rng.integers(min(k, n - 2), n - 1, (n, far))].ravel()])
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    y = np.zeros((n, dimensions))
    use = min(dimensions, u.shape[1])
    y[:, :use] = 0.01 * u[:, :use] * s[:use]
    m, v, kept = np.zeros_like(y), np.zeros_like(y), {}
    for step in range(sum(phases)):
        grad = np.zeros_like(y)
        for (i, j), weight, constant, pull in zip((near_pairs, mid_pairs, far_pairs), _phase_weights(step, phases), (10.0, 10000.0, 1.0), (True, True, False)):
            if weight == 0:
                continue
            d = y[i] - y[j]
            r = 1 + (d * d).sum(1)
            force = weight * (2 * constant / (constant + r) ** 2 if pull else -2 / (1 + r) ** 2)[:, None] * d
            np.add.at(grad, i, force)
            np.add.at(grad, j, -force)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        y -= rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-7)
        if step + 1 in snapshots:
            kept[step + 1] = y.copy()
    return y, kept


def reduce_vectors(vectors: DataFrame, key: str, vec: str, max_rows: int = 20_000, **options) -> DataFrame:
    """(key, step, vec): the embedding (step NULL) and its snapshots of a bounded set of vectors, in one task.

    More than ``max_rows`` rows are an error: fit on a sample. NULL vectors are left out.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vec).alias("vec")).where("key is not null and vec is not null")
    kind = rows.schema["key"].dataType.simpleString()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) > max_rows:
            raise ValueError(f"more than {max_rows} rows")
        frame = frame.sort_values("key", ignore_index=True)
        y, kept = embed(np.stack(frame["vec"].to_numpy()).astype(np.float64), **options)
        parts = [pd.DataFrame({"key": frame["key"], "step": step, "vec": list(z.astype(np.float32))}) for step, z in [(None, y), *kept.items()]]
        return pd.concat(parts, ignore_index=True).astype({"step": "Int32"})

    return rows.groupBy().applyInPandas(run, f"key {kind}, step int, vec array<float>").withColumnRenamed("key", key)
