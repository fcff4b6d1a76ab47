"""k nearest neighbours, exact on a grid of blocks, and an index object over a table."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Search of the perceptual-hash neighbours (fixed values): neighbours asked for, largest distance share.
NEIGHBOURS = 200
MATCH_SHARE = 0.625
METRICS = ("cosine", "euclidean", "hamming_bytes", "hamming_share", "hamming_bits")


def _matrix(values: pd.Series, metric: str) -> np.ndarray:
    if metric.startswith("hamming"):
        return np.stack([np.frombuffer(bytes(v), np.uint8) for v in values])
    x = np.stack(values.to_numpy()).astype(np.float64)
    if metric == "cosine":
        length = np.linalg.norm(x, axis=1, keepdims=True)
        x = np.divide(x, length, out=np.full_like(x, np.nan), where=length > 0)
    return x


def _distances(q: np.ndarray, p: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        return 1 - q @ p.T
    if metric == "euclidean":
        return np.sqrt(np.maximum((q * q).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * q @ p.T, 0))
    if metric == "hamming_bits":
        a, b = (np.unpackbits(x, axis=1).astype(np.float32) for x in (q, p))
        return (a.sum(1)[:, None] + b.sum(1)[None] - 2 * a @ b.T).astype(np.float64)
    unequal = np.zeros((len(q), len(p)))
    for i in range(q.shape[1]):
        unequal += q[:, i, None] != p[None, :, i]
    return unequal / q.shape[1] if metric == "hamming_share" else unequal


def knn_join(
    queries: DataFrame, points: DataFrame, key: str, vec: str, k: int = NEIGHBOURS, metric: str = "cosine",
    most: float | None = None, skip_self: bool = True, block_rows: int = 2048,
) -> DataFrame:
    """(query_id, neighbor_id, rank, distance): the k nearest points of each query, ties by neighbour id.

    Exact: query blocks meet point blocks of bounded size on a grid, each cell keeps its k best, and the
    cells of a query merge. ``most`` drops larger distances after ranking. NULL, zero (cosine) and NaN
    vectors have no neighbours and are none. ``rank`` counts the kept ones from 1.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    side = lambda df: df.select(F.col(key).alias("key"), F.col(vec).alias("vec")).where("key is not null and vec is not null")
    q, p = side(queries), side(points)
    nq, np_ = (max(1, math.ceil(x.count() / block_rows)) for x in (q, p))
    block = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q.withColumn("i", block(nq)).withColumn("j", spread(np_)).withColumn("is_query", F.lit(True))
    right = p.withColumn("j", block(np_)).withColumn("i", spread(nq)).withColumn("is_query", F.lit(False))
    kind = q.schema["key"].dataType.simpleString()

    def cell(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = frame[frame["is_query"]], frame[~frame["is_query"]]
        columns = ["query_id", "neighbor_id", "distance"]
        if not len(a) or not len(b):
            return pd.DataFrame({c: frame["key"].iloc[:0] if c != columns[2] else np.zeros(0) for c in columns})
        b = b.sort_values("key")
        d = _distances(_matrix(a["vec"], metric), _matrix(b["vec"], metric), metric)
        qk, pk = a["key"].to_numpy(), b["key"].to_numpy()
        if skip_self:
            d[qk[:, None] == pk[None]] = np.nan
        best = np.argsort(np.where(np.isnan(d), np.inf, d), axis=1, kind="stable")[:, :k]
        rows = np.repeat(np.arange(len(a)), best.shape[1])
        cols = best.ravel()
        value = d[rows, cols]
        kept = ~np.isnan(value)
        return pd.DataFrame({"query_id": qk[rows[kept]], "neighbor_id": pk[cols[kept]], "distance": value[kept]})

    parts = left.select("i", "j", "is_query", "key", "vec").unionByName(right.select("i", "j", "is_query", "key", "vec"))
    near = parts.groupBy("i", "j").applyInPandas(cell, f"query_id {kind}, neighbor_id {kind}, distance double")
    lists = near.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbor_id"))), 1, k).alias("best"))
    ranked = lists.select("query_id", F.posexplode("best").alias("at", "e")).select("query_id", "e.neighbor_id", (F.col("at") + 1).alias("rank"), "e.distance")
    return ranked if most is None else ranked.where(F.col("distance") <= most)


def neighbour_set(neighbours: DataFrame) -> DataFrame:
    """Every id that is a neighbour of some query."""
    return neighbours.select("neighbor_id").distinct()


class KnnIndex:
    """A searchable table of vectors: insert, search, search_batch, save, load.

    ``metric`` is one of METRICS; ids are kept as given. Inserting an id again replaces its vector.
    """

    def __init__(self, points: DataFrame, key: str = "id", vec: str = "vec", metric: str = "cosine"):
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric}")
        self.points, self.key, self.vec, self.metric = points.select(key, vec), key, vec, metric

    def insert(self, rows: DataFrame) -> KnnIndex:
        kept = self.points.join(rows.select(self.key), self.key, "left_anti")
        return KnnIndex(kept.unionByName(rows.select(self.key, self.vec)), self.key, self.vec, self.metric)

    def search_batch(self, queries: DataFrame, k: int = NEIGHBOURS, **options) -> DataFrame:
        return knn_join(queries, self.points, self.key, self.vec, k, self.metric, **options)

    def search(self, query, k: int = NEIGHBOURS, **options) -> DataFrame:
        schema = f"{self.key} {self.points.schema[self.key].dataType.simpleString()}, {self.vec} {self.points.schema[self.vec].dataType.simpleString()}"
        blank = "" if schema.split(" ")[1].startswith("string") else -1
        one = self.points.sparkSession.createDataFrame([(blank, query)], schema)
        return self.search_batch(one, k, **options).drop("query_id")

    def save(self, path: str, overwrite: bool = False) -> None:
        self.points.write.mode("overwrite" if overwrite else "ignore").option("metric", self.metric).parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, key: str = "id", vec: str = "vec", metric: str = "cosine") -> KnnIndex:
        return cls(spark.read.parquet(path), key, vec, metric)

    @classmethod
    def load_or_build(cls, spark: SparkSession, path: str, build, **options) -> KnnIndex:
        """The saved index, or one of ``build()`` that is saved first."""
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
            cls(build(), **options).save(path)
        return cls.load(spark, path, **options)
