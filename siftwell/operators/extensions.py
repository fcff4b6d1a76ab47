"""File-type verdicts from content, and the plans that repair names and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions import paths
from siftwell.functions.magic import detect_extension


def extension_verdicts(files: DataFrame, path: str = "path", content: str = "content", compare: str = "remote", error: str | None = None) -> DataFrame:
    """(path, status, expected_ext, error) per file.

    status: 'failed' where the content was not read (``error`` column, or NULL content) or its type is
    unknown, 'wrong' where the extension differs from the detected one, else 'ok'. ``compare``: 'local'
    ignores case, a missing extension differs; 'remote' takes the text after the last dot (the whole path
    without one), case counts; 'ingest' takes the name's extension or '', case counts.
    """
    own = {
        "local": F.lower(paths.name_extension(F.col(path))),
        "remote": paths.last_segment_extension(F.col(path)),
        "ingest": F.coalesce(paths.name_extension(F.col(path)), F.lit("")),
    }[compare]
    problem = F.when(F.col(content).isNull(), F.lit("not read"))
    if error:
        problem = F.coalesce(F.col(error), problem)
    rows = files.select(F.col(path).alias("path"), own.alias("own"), detect_extension(F.col(content)).alias("found"), problem.alias("problem"))
    failed = F.coalesce("problem", F.when(F.col("found").isNull(), F.lit("unknown type")))
    status = F.when(failed.isNotNull(), F.lit("failed")).when(F.col("own").eqNullSafe(F.col("found")), F.lit("ok")).otherwise(F.lit("wrong"))
    return rows.select("path", status.alias("status"), F.when(status == "wrong", F.col("found")).alias("expected_ext"), failed.alias("error"))


def split_verdicts(verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(wrong, failed) rows."""
    return verdicts.where("status = 'wrong'").select("path", "expected_ext"), verdicts.where("status = 'failed'").select("path", "error")


def filter_paths(files: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, path: str = "path") -> DataFrame:
    """Rows whose path contains some include text (all if there is none) and no exclude text."""
    anyone = lambda texts: F.exists(F.array(*map(F.lit, texts)), lambda t: F.contains(F.col(path), t))
    kept = files.where(F.col(path).isNotNull())
    if include:
        kept = kept.where(anyone(include))
    if exclude:
        kept = kept.where(~anyone(exclude))
    return kept


def filter_pairs(rows: DataFrame, include: list[tuple[str, str]] | None = None, skip: list[tuple[str, str]] | None = None, source: Column | None = None) -> DataFrame:
    """Rows by (extension, expected_ext): those included (if any are), then without those to skip."""
    source = paths.last_segment_extension(F.col("path")) if source is None else source
    pair = F.concat_ws(">", source, F.col("expected_ext"))
    if include:
        rows = rows.where(pair.isin(*(f"{a}>{b}" for a, b in set(include))))
    if skip:
        rows = rows.where(~pair.isin(*(f"{a}>{b}" for a, b in set(skip))))
    return rows


def rename_plan(wrong: DataFrame, **pairs) -> DataFrame:
    """(src, dst): the text before the first dot with the expected extension."""
    chosen = filter_pairs(wrong.where("path is not null and expected_ext is not null"), **pairs)
    return chosen.select(F.col("path").alias("src"), paths.rename_target(F.col("path"), F.col("expected_ext")).alias("dst"))


def payload_plan(wrong: DataFrame, prefix: str) -> DataFrame:
    """(point_id, src, dst, target_ext, format, url) for the payload of each renamed file; rows without a stem are left out."""
    rows = wrong.where("path is not null and expected_ext is not null").withColumn("point_id", paths.file_stem(F.col("path"))).where("point_id <> ''")
    return rows.select(
        "point_id", F.col("path").alias("src"), paths.stem_target(F.col("path"), F.col("expected_ext")).alias("dst"),
        F.col("expected_ext").alias("target_ext"), F.col("expected_ext").alias("format"),
        paths.payload_url(F.lit(prefix), F.col("point_id"), F.col("expected_ext")).alias("url"),
    )


def update_payload(points: DataFrame, plan: DataFrame) -> DataFrame:
    """Points (id, format, url, ...) with format and url of the plan where it has their id."""
    new = plan.groupBy(F.col("point_id").alias("id")).agg(F.max_by(F.struct("format", "url"), F.struct("src", "format")).alias("new"))
    joined = points.join(new, "id", "left")
    return joined.withColumns({c: F.coalesce(F.col("new")[c], F.col(c)) for c in ("format", "url")}).drop("new")


def ingest_plan(files: DataFrame, target: str, move: bool = False, existing: DataFrame | None = None, overwrite: bool = False, check_ext: bool = True) -> DataFrame:
    """(src, dst, action, wrong_ext): content-addressed copies or moves of files (path, content).

    dst is target/uuid5.ext; with ``check_ext`` the detected extension replaces a different one, and
    wrong_ext holds it. A copy to a dst in ``existing`` (dst) is a skip unless ``overwrite``; moves always
    go ahead. Files whose content is NULL or, with ``check_ext``, of unknown type get action 'failed'.
    """
    from siftwell.functions.ids import content_uuid

    own = F.coalesce(paths.name_extension(F.col("path")), F.lit(""))
    found = detect_extension(F.col("content"))
    rows = files.select(F.col("path").alias("src"), own.alias("own"), found.alias("found"), content_uuid(F.col("content")).alias("name"))
    ext = F.coalesce("found", "own") if check_ext else F.col("own")
    dotted = F.when(ext != "", F.concat(F.lit("."), ext)).otherwise(F.lit(""))
    rows = rows.select("src", "own", "found", F.concat(F.lit(target.rstrip("/") + "/"), "name", dotted).alias("dst"))
    bad = F.col("dst").isNull() | (F.col("found").isNull() if check_ext else F.lit(False))
    if existing is not None:
        rows = rows.join(existing.select("dst").distinct().withColumn("there", F.lit(True)), "dst", "left")
    else:
        rows = rows.withColumn("there", F.lit(None).cast("boolean"))
    go = F.lit("move") if move else F.when(F.col("there") & F.lit(not overwrite), F.lit("skip")).otherwise(F.lit("copy"))
    wrong = F.when(F.lit(check_ext) & (F.col("found") != F.col("own")), F.col("found"))
    return rows.select("src", "dst", F.when(bad, F.lit("failed")).otherwise(go).alias("action"), wrong.alias("wrong_ext"))
