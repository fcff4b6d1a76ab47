"""Object paths: plain notation, stems, extensions, targets and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_path(col: Column | str) -> Column:
    """One notation for an object path.

    Undoes percent-escapes, backslashes, ``s3://bucket/``, a leading ``./`` or ``/`` and doubled
    slashes. Letter case is kept; malformed escapes are left as they stand. NULL stays NULL.
    """
    col = F.col(col) if isinstance(col, str) else col
    decoded = F.when(
        F.contains(col, F.lit("%")),
        F.coalesce(F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B"))), col),
    ).otherwise(col)
    slashed = F.translate(decoded, "\\", "/")
    inner = F.regexp_replace(slashed, r"^[sS]3:/+[^/]*/", "")
    return F.regexp_replace(F.regexp_replace(inner, r"/{2,}", "/"), r"^(?:\./|/)+", "")


def plain_etag(col: Column) -> Column:
    """Entity tag without ``W/`` and quotes, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(col), r"^[wW]/", ""), '"', ""))


def file_name(path: Column) -> Column:
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def file_stem(path: Column) -> Column:
    """File name without its last extension; a leading dot is part of the stem."""
    return F.regexp_extract(path, r"([^/\\]+?)(\.[^./\\]*)?$", 1)


def last_segment_extension(path: Column) -> Column:
    """Text after the last dot, the whole path where there is none; case is kept."""
    return F.substring_index(path, ".", -1)


def name_extension(path: Column) -> Column:
    """Extension of the file name, NULL where there is none; case is kept."""
    ext = F.regexp_extract(file_name(path), r"^.+\.([^.]*)$", 1)
    return F.when(ext != "", ext)


def rename_target(path: Column, ext: Column) -> Column:
    """Everything before the first dot plus the new extension."""
    return F.concat(F.substring_index(path, ".", 1), F.lit("."), ext)


def stem_target(path: Column, ext: Column) -> Column:
    return F.concat(file_stem(path), F.lit("."), ext)


def prefix_kind(prefix: Column) -> Column:
    """'url' where the text has a scheme and either a host or a scheme of two or more letters, else 'path'."""
    return F.when(prefix.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]+:"), F.lit("url")).otherwise(F.lit("path"))


def point_uri(prefix: Column, point_id: Column, ext: Column) -> Column:
    """URI of a point below a prefix; NULL where prefix or extension is unknown.

    URL prefixes follow relative-reference joining, so a prefix without a final slash loses its last
    segment; path prefixes are extended by one component.
    """
    name = F.concat(point_id, F.lit("."), ext)
    hosted = F.when(prefix.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]+$"), F.concat(prefix, F.lit("/"))).otherwise(prefix)
    url = F.concat(F.regexp_replace(hosted, r"[^/]*$", ""), name)
    slash = F.when(F.contains(prefix, F.lit("\\")), F.lit("\\")).otherwise(F.lit("/"))
    path = F.when(prefix.rlike(r"[/\\]$"), F.concat(prefix, name)).otherwise(F.concat(prefix, slash, name))
    return F.when(prefix_kind(prefix) == "url", url).otherwise(path)


def payload_url(prefix: Column, point_id: Column, ext: Column) -> Column:
    return F.concat(prefix, F.lit("/"), point_id, F.lit("."), ext)
