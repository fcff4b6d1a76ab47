"""Files and object listings as tables; effects on files run from plan tables."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions.magic import HEAD_BYTES
from siftwell.functions.paths import file_stem

LISTING_SCHEMA = "path string, mode string, content_length bigint, last_modified timestamp"


def walk_files(spark: SparkSession, roots: list[str], recursive: bool = True) -> DataFrame:
    """(path, mode, content_length, last_modified, content) of the files below roots, which may be files or folders.

    ``content`` is read only where it is selected. Roots that do not exist are skipped; no root gives an
    empty table. Folders themselves are no rows, and Spark's file source leaves out files of no bytes.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = []
    for root in roots:
        target = jvm.org.apache.hadoop.fs.Path(root)
        if target.getFileSystem(conf).exists(target):
            there.append(root)
    if not there:
        return spark.createDataFrame([], LISTING_SCHEMA + ", content binary")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("ignoreMissingFiles", "true").load(there)
    return files.select("path", F.lit("FILE").alias("mode"), F.col("length").alias("content_length"), F.col("modificationTime").alias("last_modified"), "content")


def list_objects(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    return walk_files(spark, [root], recursive).drop("content")


def with_point_id(listing: DataFrame) -> DataFrame:
    """The listing with point_id, the file stem of its path."""
    return listing.withColumn("point_id", file_stem(F.col("path")))


def read_heads(listing: DataFrame, size: int = HEAD_BYTES, path: str = "path") -> DataFrame:
    """The rows plus ``head`` (first bytes) and ``error``; only the range is read, by the task of the row.

    For paths of a mounted file system; files below an object store come with walk_files.
    """
    schema = listing.schema.simpleString()[len("struct<") : -1] + ",head:binary,error:string"

    def run(batches):
        for frame in batches:
            heads, errors = [], []
            for p in frame[path]:
                try:
                    with open(p.removeprefix("file:"), "rb") as f:
                        heads.append(f.read(size))
                    errors.append(None)
                except (OSError, AttributeError) as e:
                    heads.append(None)
                    errors.append(type(e).__name__)
            yield frame.assign(head=heads, error=errors)

    return listing.mapInPandas(run, schema)


def parse_ids(rows: DataFrame, stem: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a canonical ``id``, error rows (stem, error)) by whether the stem is a UUID in some spelling."""
    from siftwell.functions.ids import canonical_uuid

    named = rows.withColumn("id", canonical_uuid(stem))
    good = F.coalesce(F.col("id").rlike(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), F.lit(False))
    return named.where(good), named.where(~good).select(F.col(stem).alias("stem"), F.lit("not a UUID").alias("error"))


def load_filter_config(path: str | None = None, include: list[str] | None = None, exclude: list[str] | None = None) -> dict[str, list[str]]:
    """Include and exclude texts of a JSON file (include_files, exclude_files) joined with those given."""
    held: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
    return {"include": [*held.get("include_files", []), *(include or [])], "exclude": [*held.get("exclude_files", []), *(exclude or [])]}


def download_plan(ids: DataFrame, root: str, target: str, ext: str = "gif") -> DataFrame:
    """(id, src, dst, action) to fetch one object per id; objects that are there are skipped when it is carried out."""
    name = F.concat("id", F.lit("." + ext))
    at = lambda folder: F.concat(F.lit(folder.rstrip("/") + "/"), name)
    return ids.select("id").where("id is not null").distinct().select("id", at(root).alias("src"), at(target).alias("dst"), F.lit("copy").alias("action"))


def object_store_settings(env: dict[str, str] | None = None, retries: int = 20) -> dict[str, str]:
    """Spark settings of an S3-compatible store from the usual environment names; absent ones are left out."""
    env = dict(os.environ) if env is None else env
    names = {
        "AWS_ACCESS_KEY_ID": "spark.hadoop.fs.s3a.access.key",
        "AWS_SECRET_ACCESS_KEY": "spark.hadoop.fs.s3a.secret.key",
        "AWS_ENDPOINT_URL": "spark.hadoop.fs.s3a.endpoint",
        "AWS_REGION": "spark.hadoop.fs.s3a.endpoint.region",
    }
    found = {key: env[name] for name, key in names.items() if env.get(name)}
    return found | {"spark.hadoop.fs.s3a.attempts.maximum": str(retries)}


def write_checkpointed(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Writes unless the target exists and ``overwrite`` is false."""
    df.write.mode("overwrite" if overwrite else "ignore").parquet(path)


def write_verdicts(wrong: DataFrame, failed: DataFrame, prefix: str) -> None:
    """<prefix>_wrong.json and <prefix>_failed.json, both always."""
    wrong.write.mode("overwrite").json(f"{prefix}_wrong.json")
    failed.write.mode("overwrite").json(f"{prefix}_failed.json")


def write_errors(errors: DataFrame, path: str) -> bool:
    """Writes the error rows only if there are any; tells whether it did."""
    if errors.isEmpty():
        return False
    errors.write.mode("overwrite").json(path)
    return True


def carry_out(plan: DataFrame, source: str = "src", target: str = "dst", action: str | None = None, overwrite: bool = False, apply: bool = False) -> DataFrame:
    """Copies, moves or renames the files of a plan; (src, dst, outcome) per row.

    Without ``apply`` nothing happens and the outcome is 'planned'. ``action`` names a column with copy,
    move, rename or skip (rename if None). A rename is a copy and then a removal. Rows are independent, and
    a repeated task finds its work done: a missing source with an existing target counts as done.
    """
    columns = [F.col(source).alias("src"), F.col(target).alias("dst"), (F.col(action) if action else F.lit("rename")).alias("action")]
    rows = plan.select(*columns)
    if not apply:
        return rows.select("src", "dst", F.lit("planned").alias("outcome"))

    def run(batches):
        import shutil

        for frame in batches:
            outcome = []
            for src, dst, what in zip(frame["src"], frame["dst"], frame["action"]):
                try:
                    a, b = src.removeprefix("file:"), dst.removeprefix("file:")
                    if what == "skip" or (what == "copy" and os.path.exists(b) and not overwrite):
                        outcome.append("skipped")
                    elif not os.path.exists(a) and os.path.exists(b):
                        outcome.append("done")
                    else:
                        os.makedirs(os.path.dirname(b) or ".", exist_ok=True)
                        part = f"{b}.part-{os.getpid()}"
                        shutil.copyfile(a, part)
                        os.replace(part, b)
                        if what in ("move", "rename") and a != b:
                            os.remove(a)
                        outcome.append("done")
                except (OSError, AttributeError) as e:
                    outcome.append(f"failed: {type(e).__name__}")
            yield frame[["src", "dst"]].assign(outcome=outcome)

    return rows.mapInPandas(run, "src string, dst string, outcome string")
