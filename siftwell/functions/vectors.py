"""Vector functions over ARRAY<FLOAT> and BINARY columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision; arrays of unequal length are an error."""
    same = F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of unequal length"))).otherwise(a)
    return _sum(F.zip_with(same, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine in double precision; NULL if either vector is NULL or all zero."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def euclidean_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))))


def l2_normalize(a: Column) -> Column:
    """The vector divided by its length; NULL for a zero vector."""
    # the length is bound by a lambda, so it is taken once a row and not once an element
    scaled = F.transform(F.array(norm(a)), lambda n: F.when(n > 0, F.transform(a, lambda x: (x / n).cast("float"))))
    return F.element_at(scaled, 1)


def bytes_to_floats(data: Column) -> Column:
    """Every byte as an unsigned number."""
    return F.transform(F.sequence(F.lit(1), F.length(data)), lambda i: F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("float"))


def sign_bytes(a: Column, dim: int) -> Column:
    """One bit per coordinate (1 where it is positive), packed into bytes, first coordinate in the highest bit."""
    def one(start: int) -> Column:
        total = F.lit(0)
        for k in range(start, min(start + 8, dim)):
            total = total + F.when(F.element_at(a, k + 1) > 0, 1 << (7 - (k - start))).otherwise(0)
        return F.lpad(F.hex(total), 2, "0")

    return F.unhex(F.concat(*(one(s) for s in range(0, dim, 8))))


def hamming_bytes(a: Column, b: Column, share: bool = False) -> Column:
    """Number of unequal bytes of two equally long values, or their share."""
    places = F.sequence(F.lit(1), F.length(a))
    unequal = F.size(F.filter(places, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))
    return unequal / F.length(a) if share else unequal


def hamming_bits(a: Column, b: Column) -> Column:
    """Number of unequal bits, eight bytes at a time."""
    words = F.sequence(F.lit(0), F.ceil(F.length(a) / 8).cast("int") - 1)
    word = lambda c, i: F.conv(F.hex(F.substring(c, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    return F.aggregate(words, F.lit(0), lambda acc, i: acc + F.bit_count(word(a, i).bitwiseXOR(word(b, i))))
