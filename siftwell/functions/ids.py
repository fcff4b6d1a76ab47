"""Identifiers: canonical spelling of UUIDs and content-derived ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: One pattern for the hyphenated, bare, braced and URN spellings, in lower case.
_SPELLED = r"^(?:urn:uuid:)?\{?([0-9a-f]{8})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{4})-?([0-9a-f]{12})\}?$"
#: Decimal numbers; 32 digits are a bare hexadecimal spelling.
_DECIMAL = r"^(?:[0-9]{1,31}|[0-9]{33,39})$"
_WORD = "cast('18446744073709551616' as decimal(20,0))"


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, whatever the number of its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hyphenate(hex32: Column) -> Column:
    return F.regexp_replace(hex32, _SPELLED, "$1-$2-$3-$4-$5")


def _decimal_to_hex32(digits: Column) -> Column:
    """128-bit hexadecimal of a decimal string, by 10**20 = 5 * 2**64 + rest in decimal arithmetic."""
    rest = F.lit(10**20 - 5 * 2**64).cast("decimal(19,0)")
    part = lambda c: F.lpad(F.lower(F.conv(c.cast("string"), 10, 16)), 16, "0")

    def words(n: Column) -> Column:
        upper = (n["high"] * F.lit(5) + ((n["mixed"] - n["lower"]) / F.expr(_WORD)).cast("decimal(20,0)")).cast("decimal(21,0)")
        return F.when(upper < F.expr(_WORD), F.concat(part(upper), part(n["lower"])))

    def split(n: Column) -> Column:
        mixed = (n["high"] * rest + n["low"]).cast("decimal(38,0)")
        lower = (mixed % F.expr(_WORD)).cast("decimal(20,0)")
        return F.struct(n["high"].alias("high"), mixed.alias("mixed"), lower.alias("lower"))

    padded = F.lpad(digits, 39, "0")
    halves = F.struct(
        padded.substr(1, 19).cast("decimal(19,0)").alias("high"), padded.substr(20, 20).cast("decimal(20,0)").alias("low")
    )
    return _let(_let(halves, split), words)


def canonical_uuid(col: Column | str) -> Column:
    """Lower-case hyphenated form of a UUID in any of its usual spellings.

    Accepted: capitals, braces, ``urn:uuid:``, no hyphens, or the plain decimal number with the same
    value. Anything else comes back trimmed and in lower case, NULL and '' as NULL.
    """
    col = F.col(col) if isinstance(col, str) else col
    text = F.nullif(F.lower(F.trim(col)), F.lit(""))
    return F.when(text.rlike(_DECIMAL), F.coalesce(_hyphenate(_decimal_to_hex32(text)), text)).otherwise(_hyphenate(text))


def numeric_id_to_uuid(col: Column) -> Column:
    """The UUID whose 128-bit value is a non-negative BIGINT."""
    return F.when(col >= 0, _hyphenate(F.lpad(F.lower(F.hex(col)), 32, "0")))


#: Namespace of the content ids (fixed value).
CONTENT_NAMESPACE = "4f201753-32b8-5108-aa76-d2e8c65310f4"


def content_uuid(data: Column, namespace: str = CONTENT_NAMESPACE) -> Column:
    """Name-based (version 5) UUID of the lower-case hex SHA-1 of the bytes; NULL stays NULL."""
    space = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.sha1(F.concat(space, F.sha1(data).cast("binary")))
    variant = F.conv(digest.substr(17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    hex32 = F.concat(
        digest.substr(1, 12), F.lit("5"), digest.substr(14, 3), F.lower(F.hex(variant)), digest.substr(18, 15)
    )
    return _hyphenate(hex32)
