"""Vector tables: an insertion-ordered keyed table of fixed-length vectors with optional metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.functions.paths import point_uri, prefix_kind
from siftwell.functions.vectors import cosine_similarity

_UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def scan_points(points: DataFrame, vector: str = "image_vector") -> DataFrame:
    """(id, vec) of the points with a UUID id and the named vector; other rows are dropped."""
    return points.where(F.col("id").rlike(_UUID) & F.col(vector).isNotNull()).select("id", F.col(vector).alias("vec"))


def points_by_ids(points: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows of the listed ids; the planner broadcasts the list where its size allows."""
    return points.join(ids.select(key).distinct(), key, "left_semi")


def must_match(rows: DataFrame, lookup: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """Inner join to the last row of each key in ``lookup`` by ``order``; a row without a match is an error."""
    held = F.max_by(F.struct(*[c for c in lookup.columns if c != key]), F.col(order))
    last = lookup.groupBy(key).agg(held.alias("held"))
    joined = rows.join(last, key, "left")
    checked = F.when(F.col("held").isNull(), F.raise_error(F.concat(F.lit("no row for "), F.col(key).cast("string")))).otherwise(F.col("held")[column])
    return joined.withColumn(column, checked).drop("held")


class PointTable:
    """Rows (idx, id, vec) with a dense index in order of insertion.

    Every change gives a new table. Inserting a known id overwrites its vector and keeps its place;
    removing closes the gap. ``metadata`` (id, ...), ``ext`` (id, ext) and ``prefixes`` (key, prefix) are
    optional side tables.
    """

    def __init__(self, rows: DataFrame, dim: int, metadata: DataFrame | None = None, ext: DataFrame | None = None, prefixes: dict[str, str] | None = None):
        self.rows, self.dim, self.metadata, self.ext, self.prefixes = rows, dim, metadata, ext, dict(prefixes or {})

    @classmethod
    def builder(cls, dim: int) -> PointTableBuilder:
        return PointTableBuilder(dim)

    def _with(self, rows: DataFrame) -> PointTable:
        return PointTable(rows, self.dim, self.metadata, self.ext, self.prefixes)

    def _checked(self, vec: Column) -> Column:
        wrong = F.raise_error(F.concat(F.lit(f"expected {self.dim} elements, got "), F.size(vec).cast("string")))
        return F.when(F.size(vec) == self.dim, vec).otherwise(wrong)

    def insert(self, new: DataFrame, order: str) -> PointTable:
        """Rows (id, vec) of ``new`` in the order of a column; of several rows of an id the last one counts."""
        last = new.where("id is not null").groupBy("id").agg(F.max_by("vec", order).alias("new_vec"), F.min(order).alias("new_at"))
        joined = self.rows.join(last, "id", "full")
        vec = self._checked(F.coalesce("new_vec", "vec"))
        return self._with(_dense(joined.select("id", vec.alias("vec"), F.col("idx").isNull().alias("late"), F.coalesce("idx", "new_at").alias("at")), "late", "at", "id"))

    def remove(self, ids: DataFrame) -> PointTable:
        return self._with(_dense(self.rows.join(ids.select("id").distinct(), "id", "left_anti"), "idx"))

    def clear(self) -> PointTable:
        return self._with(self.rows.limit(0))

    def contains(self, ids: DataFrame) -> DataFrame:
        here = self.rows.select("id", F.lit(True).alias("found"))
        return ids.select("id").distinct().join(here, "id", "left").select("id", F.coalesce("found", F.lit(False)).alias("found"))

    def __len__(self) -> int:
        return self.rows.count()

    def is_empty(self) -> bool:
        return self.rows.isEmpty()

    def __iter__(self):
        for row in self.rows.orderBy("idx").select("id", "vec").toLocalIterator():
            yield row["id"], row["vec"]

    def ids(self) -> DataFrame:
        return self.rows.orderBy("idx").select("id")

    def items(self) -> DataFrame:
        return self.rows.orderBy("idx").select("id", "vec")

    def index_to_id(self, index: int) -> str | None:
        row = self.rows.where(F.col("idx") == index).select("id").first()
        return row["id"] if row else None

    def id_to_index(self, point: str) -> int | None:
        row = self.rows.where(F.col("id") == point).select("idx").first()
        return row["idx"] if row else None

    def vector(self, point: str) -> list | None:
        row = self.rows.where(F.col("id") == point).select("vec").first()
        return list(row["vec"]) if row else None

    def point_metadata(self, point: str):
        return None if self.metadata is None else self.metadata.where(F.col("id") == point).first()

    def similarity(self, a: str, b: str) -> float:
        """Cosine of two points; an unknown id is a KeyError."""
        held = {r["id"]: r["vec"] for r in self.rows.where(F.col("id").isin(a, b)).collect()}
        for point in (a, b):
            if point not in held:
                raise KeyError(point)
        one = self.rows.sparkSession.createDataFrame([(held[a], held[b])], "a array<double>, b array<double>")
        return one.select(cosine_similarity(F.col("a"), F.col("b"))).first()[0]

    def uris(self, prefix_key: str) -> DataFrame:
        """(id, uri) below a prefix; NULL where the prefix or the extension is unknown."""
        prefix = F.lit(self.prefixes.get(prefix_key)).cast("string")
        ext = self.ext if self.ext is not None else self.rows.select("id", F.lit(None).cast("string").alias("ext")).limit(0)
        return self.rows.select("id").join(ext.select("id", "ext"), "id", "left").select("id", point_uri(prefix, F.col("id"), F.col("ext")).alias("uri"))

    def prefix_kinds(self) -> DataFrame:
        spark = self.rows.sparkSession
        return spark.createDataFrame(list(self.prefixes.items()), "key string, prefix string").withColumn("kind", prefix_kind(F.col("prefix")))

    def save(self, path: str, overwrite: bool = True) -> None:
        self.rows.write.mode("overwrite" if overwrite else "ignore").parquet(path)


class PointTableBuilder:
    def __init__(self, dim: int):
        self._dim, self._path, self._rows = dim, None, None
        self._metadata = self._ext = None
        self._prefixes: dict[str, str] = {}

    def path(self, path: str) -> PointTableBuilder:
        self._path = path
        return self

    def rows(self, rows: DataFrame, order: str) -> PointTableBuilder:
        self._rows = (rows, order)
        return self

    def metadata(self, rows: DataFrame) -> PointTableBuilder:
        self._metadata = rows
        return self

    def ext(self, rows: DataFrame) -> PointTableBuilder:
        self._ext = rows
        return self

    def uri_prefix(self, key: str, prefix: str) -> PointTableBuilder:
        self._prefixes[key] = prefix
        return self

    def build(self, spark: SparkSession) -> PointTable:
        empty = spark.createDataFrame([], "idx bigint, id string, vec array<float>")
        held = spark.read.parquet(self._path) if self._path else empty
        table = PointTable(held, self._dim, self._metadata, self._ext, self._prefixes)
        return table.insert(*self._rows) if self._rows else table


def _dense(rows: DataFrame, *order: str) -> DataFrame:
    """(idx, id, vec) numbered from 0 by ``order``: ranges are counted, so no task holds all rows."""
    columns = list(order)
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = rows.repartitionByRange(parts, *columns).sortWithinPartitions(*columns).withColumn("_row", F.monotonically_increasing_id())
    from siftwell.runtime import Workspace

    held = Workspace(rows.sparkSession, "points").save(sorted_rows)
    counts = held.groupBy(F.shiftright("_row", 33).alias("_part")).agg(F.count("*").alias("n"))
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = held.withColumn("_part", F.shiftright("_row", 33)).join(F.broadcast(offsets.select("_part", "before")), "_part")
    return placed.select((F.col("before") + F.col("_row").bitwiseAND((1 << 33) - 1)).alias("idx"), "id", "vec")
