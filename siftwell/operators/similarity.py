"""Pairs of similar vectors: exact on a grid of blocks, or by banded signs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.vectors import cosine_similarity

#: Thresholds of near-duplicate images and texts (fixed values).
IMAGE_THRESHOLD = 0.985
TEXT_THRESHOLD = 0.9


def _pair_kernel(least: float, strict: bool):
    def kernel(frame: pd.DataFrame) -> pd.DataFrame:
        low, high = frame["lo"].iloc[0], frame["hi"].iloc[0]
        a, b = frame[frame["block"] == low], frame[frame["block"] == high]

        def unit(part: pd.DataFrame) -> np.ndarray:
            x = np.stack(part["vec"].to_numpy()).astype(np.float64)
            length = np.linalg.norm(x, axis=1, keepdims=True)
            return np.divide(x, length, out=np.full_like(x, np.nan), where=length > 0)

        empty = pd.DataFrame({"a": a["key"].iloc[:0], "b": a["key"].iloc[:0], "similarity": np.zeros(0)})
        if not len(a) or not len(b):
            return empty
        with np.errstate(invalid="ignore"):
            s = unit(a) @ unit(b).T
            hit = (s > least) if strict else (s >= least)
        ka, kb = a["key"].to_numpy(), b["key"].to_numpy()
        row, col = np.nonzero(hit)
        row, col, value = ka[row], kb[col], s[row, col]
        if low == high:
            kept = row < col
            row, col, value = row[kept], col[kept], value[kept]
        swap = row > col
        return pd.DataFrame({"a": np.where(swap, col, row), "b": np.where(swap, row, col), "similarity": value})

    return kernel


def similar_pairs(
    vectors: DataFrame, key: str, vec: str, least: float = IMAGE_THRESHOLD, strict: bool = False,
    strategy: str = "exact", block_rows: int = 2048, bands: int = 32, band_bits: int = 12,
) -> DataFrame:
    """(a, b, similarity) with a < b and a cosine of at least (``strict``: above) ``least``.

    'exact' compares all pairs once on a grid: rows hash into blocks and a task multiplies two blocks of a
    bounded size. 'lsh' compares only rows that agree in a band of ``band_bits`` signs of random
    projections, of ``bands`` bands; it may lose pairs, and its work follows the number of candidates.
    Zero, NULL and NaN vectors are similar to nothing.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vec).alias("vec")).where("key is not null and vec is not null")
    if strategy == "lsh":
        return _banded(rows, least, strict, bands, band_bits)
    blocks = max(1, math.ceil(rows.count() / block_rows))
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    placed = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cells = placed.select("key", "vec", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    kind = rows.schema["key"].dataType.simpleString()
    return cells.groupBy("lo", "hi").applyInPandas(_pair_kernel(least, strict), f"a {kind}, b {kind}, similarity double")


def _banded(rows: DataFrame, least: float, strict: bool, bands: int, bits: int) -> DataFrame:
    @F.pandas_udf("array<bigint>")
    def band_keys(vec: pd.Series) -> pd.Series:
        if not len(vec):
            return pd.Series([], dtype=object)
        x = np.stack(vec.to_numpy()).astype(np.float64)
        planes = np.random.default_rng(11).normal(size=(x.shape[1], bands * bits))
        signs = (x @ planes > 0).reshape(len(x), bands, bits).astype(np.int64)
        keys = signs @ (1 << np.arange(bits)) + (np.arange(bands) << bits)
        return pd.Series(list(keys))

    keyed = rows.select("key", "vec", F.explode(band_keys("vec")).alias("band"))
    pairs = keyed.select("key", "band").alias("l").join(keyed.select("key", "band").alias("r"), "band").where("l.key < r.key")
    pairs = pairs.select(F.col("l.key").alias("a"), F.col("r.key").alias("b")).distinct()
    left, right = rows.select(F.col("key").alias("a"), F.col("vec").alias("va")), rows.select(F.col("key").alias("b"), F.col("vec").alias("vb"))
    scored = pairs.join(left, "a").join(right, "b").select("a", "b", cosine_similarity(F.col("va"), F.col("vb")).alias("similarity"))
    near = F.col("similarity") > least if strict else F.col("similarity") >= least
    return scored.where(near & ~F.isnan("similarity"))


def pairs_of_ids(vectors: DataFrame, ids: DataFrame, key: str, vec: str) -> DataFrame:
    """(a, b, similarity) of all pairs a < b of the listed ids; an id without a vector is an error.

    The list is one that a person looks at; its square is what the operator returns.
    """
    wanted = ids.select(key).distinct().join(vectors.select(key, vec), key, "left")
    known = F.when(F.col(vec).isNull(), F.raise_error(F.concat(F.lit("unknown id "), F.col(key).cast("string")))).otherwise(F.col(vec))
    checked = wanted.select(key, known.alias(vec))
    return similar_pairs(checked, key, vec, least=-2.0)
