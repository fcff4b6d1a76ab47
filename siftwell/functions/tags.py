"""Tags: one spelling, and clean tag sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_tag(tag: Column) -> Column:
    """Lower case, trimmed, every run of white space, ``_`` and ``-`` as one space."""
    return F.trim(F.regexp_replace(F.lower(tag), r"[\s_\-]+", " "))


def plain_tags(tags: Column) -> Column:
    """Sorted distinct plain tags without empty ones; a NULL array counts as empty."""
    clean = F.filter(F.transform(tags, plain_tag), lambda t: t.isNotNull() & (t != ""))
    return F.coalesce(F.array_sort(F.array_distinct(clean)), F.array().cast("array<string>"))
