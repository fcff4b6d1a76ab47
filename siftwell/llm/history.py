"""Deduplication of new batches against everything accepted before.

A vector's fingerprint takes one bit from the difference of each pair of projected coordinates, so the
number of unequal bits grows with the angle. Fingerprints are stored in block tables: each table is
keyed by another rotation's leading bits. A new record looks up exact block matches, which are verified
by Hamming distance and then by the vectors themselves; records that match nothing accepted are appended.
Who is a case depends on the order of arrival only: a record is one if an earlier record that is not a
case matches it, which is resolved in rounds from the earliest records on.

Blocks get wider as records are added and tables more, so that a block keeps about as many records and a
pair at the bound the same chance to meet: with n records the candidates grow as n to the power 1.22.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions.paths import plain_path
from siftwell.llm.vectors import first_of_copies, point_batches, point_vectors
from siftwell.runtime import Workspace

WORDS = 6  # of the fingerprint that is compared
FINE_BITS = 24
_W = [f"w{i}" for i in range(WORDS)]


@dataclass(frozen=True)
class BlockPlan:
    """Width of a block and number of tables."""

    bits: int
    tables: int

    @property
    def per_word(self) -> int:
        return 64 // self.bits

    @property
    def words(self) -> int:
        return max(WORDS, math.ceil(self.tables / self.per_word))


def block_plan(records: int, least: float = 0.9, load: float = 256, miss: float = 0.0063) -> BlockPlan:
    """Blocks of about ``load`` of so many records at most, and tables enough for a pair at ``least`` to miss all with a chance of ``miss``."""
    bits = min(32, max(12, math.ceil(math.log2(max(records, 1) / load))))
    equal = (1 - math.acos(least) / math.pi) ** bits
    return BlockPlan(bits, math.ceil(math.log(miss) / math.log(1 - equal)))


def hamming_limit(cosine: float, sigmas: float = 4.5) -> int:
    """Unequal bits that a pair above ``cosine`` stays within, by so many standard deviations."""
    bits, p = 64 * WORDS, math.acos(cosine) / math.pi
    return math.ceil(bits * p + sigmas * math.sqrt(bits * p * (1 - p)))


def fingerprints(vectors: DataFrame, plan: BlockPlan = block_plan(0), seed: int = 20240229) -> DataFrame:
    """``vectors`` (with vec) plus the words w0.. of the bit-difference fingerprint, as many as the plan's tables need."""
    names = [f"w{i}" for i in range(plan.words)]
    schema = vectors.schema.simpleString()[len("struct<") : -1] + "".join(f",{w}:bigint" for w in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = None
        for frame in batches:
            if len(frame):
                x = np.stack(frame["vec"].to_numpy()).astype(np.float64)
                if planes is None:
                    projected = np.random.default_rng(seed).normal(size=(x.shape[1], 2 * 64 * len(names)))
                    planes = projected[:, 0::2] - projected[:, 1::2]
                packed = np.packbits(x @ planes > 0, axis=1).view(">i8").astype(np.int64)
            else:
                packed = np.zeros((0, len(names)), np.int64)
            yield frame.assign(**{w: packed[:, i] for i, w in enumerate(names)})

    return vectors.mapInPandas(run, schema)


def block_rows(prints: DataFrame, key: str, plan: BlockPlan = block_plan(0)) -> DataFrame:
    """(block, key, w0..): one row per table; block holds the table's number and the leading bits of its rotation."""
    mask = (1 << plan.bits) - 1
    kind = "int" if plan.tables << plan.bits < 1 << 31 else "bigint"
    blocks = [
        F.shiftrightunsigned(F.col(f"w{t // plan.per_word}"), 64 - plan.bits * (t % plan.per_word + 1)).bitwiseAND(mask).cast(kind)
        + F.lit(t << plan.bits).cast(kind)
        for t in range(plan.tables)
    ]
    return prints.select(F.explode(F.array(*blocks)).alias("block"), F.col(key), *_W)


def _close(limit: int) -> Column:
    unequal = None
    for w in _W:
        bits = F.bit_count(F.col(f"l.{w}").bitwiseXOR(F.col(f"r.{w}")))
        unequal = bits if unequal is None else unequal + bits
    return unequal <= limit


def block_matches(stored: DataFrame, new: DataFrame, key: str, limit: int, ordered: bool = True) -> DataFrame:
    """Distinct (earlier, later) keys of stored and new records with an equal block and a Hamming distance within the limit.

    With ``ordered`` the stored one must have the lesser key; without, whatever is stored is earlier. An
    equi-join on the block with the distance as its condition, so only verified pairs leave it; a block
    that many fingerprints share is a join skew, which adaptive execution splits.
    """
    on = (F.col("l.block") == F.col("r.block")) & _close(limit)
    if ordered:
        on = on & (F.col(f"l.{key}") < F.col(f"r.{key}"))
    pairs = stored.alias("l").join(new.alias("r"), on)
    return pairs.select(F.col(f"l.{key}").alias("earlier"), F.col(f"r.{key}").alias("later")).distinct()


def _product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def _length(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision."""
    return _product(a, b) / (_length(a) * _length(b))


def verified(pairs: DataFrame, earlier: DataFrame, later: DataFrame, key: str, least: float) -> DataFrame:
    """Those pairs whose vectors have a cosine above ``least``; lengths are computed once a row."""
    a = earlier.select(F.col(key).alias("earlier"), F.col("vec").alias("va"), _length(F.col("vec")).alias("la"))
    b = later.select(F.col(key).alias("later"), F.col("vec").alias("vb"), _length(F.col("vec")).alias("lb"))
    both = pairs.join(a, "earlier").join(b, "later")
    return both.where(_product(F.col("va"), F.col("vb")) / (F.col("la") * F.col("lb")) > least).select("earlier", "later")


def resolve_in_order(edges: DataFrame, work: Workspace) -> DataFrame:
    """(later): the records that match an earlier record which is itself not a case; ``edges`` is a saved table with its number of rows.

    Each round accepts the records without an undecided earlier match, marks what they match as cases and
    drops all edges of these; at least the earliest undecided record is settled in every round.
    """
    left, number = edges, F.count(F.lit(1))  # taken in the job that writes
    cases: DataFrame | None = None
    while work.metric(left):
        accepted = left.select("earlier").distinct().join(left.select(F.col("later").alias("earlier")), "earlier", "left_anti")
        hit = work.save(left.join(accepted, "earlier", "left_semi").select("later").distinct())
        cases = hit if cases is None else cases.unionByName(hit)
        after = left.join(hit, "later", "left_anti").join(hit.withColumnRenamed("later", "earlier"), "earlier", "left_anti")
        after = work.save(after.select("earlier", "later"), rows=number)
        if left is not edges:
            work.drop(left)
        left = after
    return left.select("later") if cases is None else cases.distinct()


def leader_pairs(prints: DataFrame, key: str) -> DataFrame:
    """Distinct (earlier, later): every record with the first record of each pair of blocks it shares.

    Twice 24 bits of each word make fine buckets. A group of near-copies of any size has a few fine buckets
    with most of its members, and gives one pair per member and bucket here, not the square of its size.
    """
    mask = (1 << FINE_BITS) - 1
    fine = [
        F.shiftrightunsigned(F.col(w), 64 - FINE_BITS * (t + 1)).bitwiseAND(mask) + F.lit((i * 2 + t) << FINE_BITS)
        for i, w in enumerate(_W)
        for t in range(2)
    ]
    rows = prints.select(F.explode(F.array(*fine)).alias("fine"), F.col(key).alias("later"))
    leaders = rows.groupBy("fine").agg(F.min("later").alias("earlier"))
    return rows.join(leaders, "fine").where("earlier < later").select("earlier", "later").distinct()


def cases_in_order(prints: DataFrame, key: str, least: float, work: Workspace, plan: BlockPlan) -> DataFrame:
    """(later): the cases among ``prints`` (key, vec, w0..), whose order of arrival is that of the key.

    Leaders come first: what matches the first record of a fine bucket is likely a case, and drops out
    before blocks are compared. The accepted records are then compared among themselves in all block
    tables; any match adds an edge and the order is resolved again, until the accepted ones match each
    other nowhere. As every case has an accepted earlier match and no two accepted records match, the
    result is that of taking one record after the other.
    """
    limit = hamming_limit(least)
    number = F.count(F.lit(1))
    edges = work.save(verified(leader_pairs(prints, key), prints, prints, key, least), rows=number)
    cases = work.save(resolve_in_order(edges, work))
    seen = fresh = work.save(prints.join(cases.withColumnRenamed("later", key), key, "left_anti"))
    first = True
    while True:
        new, held = block_rows(fresh, key, plan), block_rows(seen, key, plan)
        pairs = block_matches(new, new, key, limit) if first else block_matches(held, new, key, limit).unionByName(block_matches(new, held, key, limit)).distinct()
        more = work.save(verified(pairs, prints, prints, key, least), rows=number)
        if not work.metric(more):
            return cases
        edges, first = work.save(edges.unionByName(more), rows=number), False
        cases = work.save(resolve_in_order(edges, work))
        accepted = prints.join(cases.withColumnRenamed("later", key), key, "left_anti")
        fresh = work.save(accepted.join(seen.select(key), key, "left_anti"), rows=number)
        if not work.metric(fresh):
            return cases
        seen = seen.unionByName(fresh)


def vector_repeats(vectors: DataFrame, order: str = "arrived", least: float = 0.9) -> DataFrame:
    """(order) of the records of ``vectors`` (order, vec) that repeat an earlier accepted one.

    ``order`` is unique and rises with arrival. Records with equal numbers are set apart first: all but
    the first of them are cases whatever becomes of the first. Empty input gives an empty result.
    """
    work = Workspace(vectors.sparkSession, "history")
    held = work.save(vectors.select(order, "vec"))
    plan = block_plan(held.count(), least)
    first = work.save(fingerprints(first_of_copies(held, order), plan))
    near = cases_in_order(first, order, least, work, plan).withColumnRenamed("later", order)
    copies = held.select(order).join(first.select(order), order, "left_anti")
    return copies.unionByName(near)


def _path_prints(records: DataFrame) -> DataFrame:
    """(print, object, batch_no, row_id): one 64-bit fingerprint of each object's plain path, the only block of its table."""
    rows = records.where("path is not null and row_id is not null").select("row_id", "batch_no", plain_path("path").alias("object"))
    return rows.select(F.xxhash64("object").alias("print"), "object", "batch_no", "row_id")


def path_repeats(records: DataFrame) -> DataFrame:
    """(row_id) of records (row_id, batch_no, path) that name an object which an earlier record names.

    The order is batch_no, then row_id; repeated deliveries of a row_id are one record. Two records match
    at a Hamming distance of zero only, so the whole fingerprint is the block; the text decides among equal
    blocks. NULL paths name nothing. The first record of each object is found by a minimum combined before
    the shuffle, so one object may hold any share of the rows.
    """
    rows = _path_prints(records)
    first = rows.groupBy("print", "object").agg(F.min(F.struct("batch_no", "row_id"))["row_id"].alias("row_id")).select("row_id")
    return rows.select("row_id").distinct().join(first, "row_id", "left_anti")


class BatchTable:
    """A table on disk that grows by batches and is bucketed by one column, so that joins on it do not shuffle it.

    Rows count once their batch is committed by a file of its own, made last: what a job that failed has
    written is never read. A new object over an existing path goes on where the last one ended.
    """

    def __init__(self, spark: SparkSession, path: str, columns: str, bucket: str, buckets: int):
        self.spark, self.path = spark, path.rstrip("/")
        self.name = "history_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, batch STRING) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY ({bucket}) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )
        self.bucket, self.buckets = bucket, buckets

    def append(self, rows: DataFrame, batch: str) -> None:
        """Adds rows (the columns in their order) under a batch that is not committed yet."""
        placed = rows.repartition(self.buckets, self.bucket).withColumn("batch", F.lit(batch))
        placed.write.insertInto(self.name)

    def read(self, batches: list[str]) -> DataFrame:
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return self.spark.table(self.name).where(F.col("batch").isin(batches)).drop("batch")


class Commits:
    """Names of the finished batches, one empty file each, with the number of rows accepted."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        found = self._files.globStatus(self._hadoop(f"{self.path}/*-*")) or []
        return sorted(f.getPath().getName() for f in found)

    def batches(self) -> list[str]:
        return [n.split("-")[0] for n in self._names()]

    def rows(self, first: bool = False) -> int:
        held = [int(n.split("-")[1]) for n in self._names()]
        return held[0] if first else sum(held)

    def add(self, batch: str, rows: int) -> None:
        self._files.create(self._hadoop(f"{self.path}/{batch}-{rows}"), False).close()


class FingerprintHistory:
    """Accepted records on disk: their vectors, and their block tables, bucketed by block.

    ``process(batch)`` gives the cases of a batch and appends the others; whatever is stored is earlier than
    the batch, whatever its keys. Only the batch is shuffled to the stored blocks, and only the vectors of
    candidates are read further. Both tables are committed at once, by one file. A new object over an
    existing path goes on where the last one ended. When the history has grown to four times what its block
    width is meant for, the block tables are written anew with wider blocks. ``load`` is that of block_plan;
    ``buckets`` is set when the history is made, as many as the cores that shall look it up.
    """

    def __init__(self, spark: SparkSession, path: str, order: str = "arrived", least: float = 0.9, load: float = 256, buckets: int = 16):
        self.spark, self.path, self.order, self.least, self.load = spark, path.rstrip("/"), order, least, load
        self.commits = Commits(spark, f"{self.path}/commits")
        self._widths = Commits(spark, f"{self.path}/widths")
        if not self._widths.batches():
            self._widths.add(str(block_plan(0, least, load).bits), buckets)
        self.buckets = self._widths.rows(first=True)
        self._set_width(max(map(int, self._widths.batches())))

    def _set_width(self, bits: int) -> None:
        self.plan = block_plan(math.floor(self.load * 2**bits), self.least, self.load)
        self.vectors = BatchTable(self.spark, f"{self.path}/vectors", f"{self.order} BIGINT, vec ARRAY<FLOAT>", self.order, self.buckets)
        kind = "INT" if self.plan.tables << self.plan.bits < 1 << 31 else "BIGINT"
        words = ", ".join(f"{w} BIGINT" for w in _W)
        self.blocks = BatchTable(self.spark, f"{self.path}/blocks{bits}", f"block {kind}, {self.order} BIGINT, {words}", "block", self.buckets)

    def _widen(self, done: list[str]) -> None:
        """Block tables for the records of the committed batches at the width that their number asks for."""
        wider = block_plan(self.commits.rows(), self.least, self.load)
        if wider.bits < self.plan.bits + 2:
            return
        self._set_width(wider.bits)
        stored = fingerprints(self.vectors.read(done), self.plan)
        token = uuid.uuid4().hex  # rows of an earlier attempt stay unread
        self.blocks.append(block_rows(stored, self.order, self.plan), token)
        Commits(self.spark, f"{self.path}/rebuilt{wider.bits}").add(token, len(done))
        self._widths.add(str(wider.bits), self.buckets)  # last: from here on the new table is read

    def _block_batches(self, done: list[str]) -> list[str]:
        """Batches of the block table: a rebuilt one stands for all that were committed before it."""
        return [*Commits(self.spark, f"{self.path}/rebuilt{self.plan.bits}").batches(), *done]

    def process(self, batch: DataFrame) -> DataFrame:
        """(order) of the records of ``batch`` (order, vec) that repeat an accepted one; the others are accepted."""
        work, key, limit = Workspace(self.spark, "batch"), self.order, hamming_limit(self.least)
        done = self.commits.batches()
        if done:
            self._widen(done)
        held = work.save(batch.where(F.col(key).isNotNull() & F.col("vec").isNotNull()).select(F.col(key).cast("bigint").alias(key), F.col("vec").cast("array<float>").alias("vec")))
        fresh = prints = work.save(fingerprints(first_of_copies(held, key), self.plan))
        if done:
            stored = self.blocks.read(self._block_batches(done))
            pairs = work.save(block_matches(stored, block_rows(prints, key, self.plan), key, limit, ordered=False))
            hits = verified(pairs, self.vectors.read(done), prints, key, self.least)
            known = work.save(hits.select(F.col("later").alias(key)).distinct())
            fresh = work.save(prints.join(known, key, "left_anti"))
        near = cases_in_order(fresh, key, self.least, work, self.plan).withColumnRenamed("later", key)
        accepted = work.save(fresh.join(near, key, "left_anti"))
        token = uuid.uuid4().hex
        self.vectors.append(accepted.select(key, "vec"), token)
        self.blocks.append(block_rows(accepted, key, self.plan), token)
        self.commits.add(token, accepted.count())
        return held.select(key).join(accepted.select(key), key, "left_anti")


class PathHistory:
    """Accepted paths on disk as a fingerprint table, looked up by the fingerprint and verified by the text."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, root = spark, path.rstrip("/")
        self.commits, made = Commits(spark, f"{root}/commits"), Commits(spark, f"{root}/made")
        if not made.batches():
            made.add("buckets", buckets)
        self.prints = BatchTable(spark, f"{root}/prints", "print BIGINT, object STRING", "print", made.rows())

    def process(self, batch: DataFrame) -> DataFrame:
        """(row_id) of the records of ``batch`` (row_id, batch_no, path) that name an accepted object; the others are accepted."""
        work = Workspace(self.spark, "paths")
        rows = work.save(_path_prints(batch))
        first = rows.groupBy("print", "object").agg(F.min(F.struct("batch_no", "row_id"))["row_id"].alias("row_id"))
        done = self.commits.batches()
        if done:
            first = first.join(self.prints.read(done), ["print", "object"], "left_anti")
        first = work.save(first)
        token = uuid.uuid4().hex
        self.prints.append(first.select("print", "object"), token)
        self.commits.add(token, first.count())
        return rows.select("row_id").distinct().join(first.select("row_id"), "row_id", "left_anti")


def repeats_of_tables(points: DataFrame, wrong_ext: DataFrame) -> DataFrame:
    """(rec_table, rec_key): points by vector and wrong-extension records by path that repeat an earlier one."""
    work = Workspace(points.sparkSession, "repeats")
    vectors = work.save(point_vectors(points))
    again = vector_repeats(vectors).join(vectors.select("arrived", "id"), "arrived")
    by_vector = again.select(F.lit("point_metadata").alias("rec_table"), F.col("id").alias("rec_key"))
    by_path = path_repeats(wrong_ext).select(F.lit("wrong_ext").alias("rec_table"), F.col("row_id").cast("string").alias("rec_key"))
    return by_vector.unionByName(by_path)


def repeats_by_batch(points: DataFrame, wrong_ext: DataFrame, folder: str) -> DataFrame:
    """The rows of repeats_of_tables, from histories in ``folder`` that take one delivered batch after the other.

    A point comes with the batch of its smallest idx, a wrong-extension record with the first batch that
    delivers its row_id. The number of batches is all that the driver holds.
    """
    spark = points.sparkSession
    work = Workspace(spark, "repeats")
    vectors = work.save(point_batches(points))
    first = F.min(F.struct("batch_no", "path"))
    records = work.save(wrong_ext.where("row_id is not null").groupBy("row_id").agg(first.alias("r")).select("row_id", "r.*"))
    by_vector, by_path = FingerprintHistory(spark, f"{folder}/vectors"), PathHistory(spark, f"{folder}/paths")
    batches = lambda rows: [r[0] for r in rows.select("batch_no").distinct().orderBy("batch_no").collect()]
    out = spark.createDataFrame([], "rec_table string, rec_key string")
    for b in batches(vectors):
        again = by_vector.process(vectors.where(F.col("batch_no").eqNullSafe(b))).join(vectors.select("arrived", "id"), "arrived")
        out = out.unionByName(again.select(F.lit("point_metadata").alias("rec_table"), F.col("id").alias("rec_key")))
    for b in batches(records):
        again = by_path.process(records.where(F.col("batch_no").eqNullSafe(b)))
        out = out.unionByName(again.select(F.lit("wrong_ext").alias("rec_table"), F.col("row_id").cast("string").alias("rec_key")))
    return out
