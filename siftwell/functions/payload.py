"""Typed columns out of dynamic payloads kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_int(payload: Column, key: str) -> Column:
    return F.try_variant_get(F.try_parse_json(payload), f"$.{key}", "bigint")


def payload_string(payload: Column, key: str) -> Column:
    """The value under the key where it is a string, else NULL."""
    value = F.try_variant_get(F.try_parse_json(payload), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def payload_strings(payload: Column, key: str) -> Column:
    """String elements of a list; other elements are dropped, and what is no list gives NULL."""
    items = F.try_variant_get(F.try_parse_json(payload), f"$.{key}", "array<variant>")
    strings = F.filter(items, lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
    return F.transform(strings, lambda x: F.try_variant_get(x, "$", "string"))


def text_info(vector: Column, text: Column) -> Column:
    """STRUCT<text, text_vector>, present only where both parts are."""
    return F.when(vector.isNotNull() & text.isNotNull(), F.struct(text.alias("text"), vector.alias("text_vector")))


def layout_on_circle(index: Column, n: Column, size: int) -> Column:
    """(x, y) of the index-th of n nodes on a circle of 0.4 times the size, in whole pixels."""
    angle = 2 * F.pi() * index / n
    at = lambda f: F.round(F.lit(size / 2) + F.lit(0.4 * size) * f(angle)).cast("bigint")
    return F.struct(at(F.cos).alias("x"), at(F.sin).alias("y"))
