"""Frames of animations: which to keep, and whether they differ."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sampled_frames(n: Column, refuse_poor: bool = False) -> Column:
    """Indices of the frames to embed: all of fewer than five, else first, quarters and last.

    With ``refuse_poor`` fewer than five frames are an error; NULL stays NULL.
    """
    few = F.when(n <= 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), (n - 1).cast("int")))
    if refuse_poor:
        few = F.raise_error(F.lit("fewer than five frames"))
    part = lambda k: F.floor(n * k / 4).cast("int")
    many = F.array_distinct(F.array(F.lit(0), part(1), part(2), part(3), (n - 1).cast("int")))
    return F.when(n < 5, few).when(n >= 5, many)


def frames_identical(hashes: Column, distance: Callable[[Column, Column], Column], limit: float = 5) -> Column:
    """True if every frame's hash is nearer than ``limit`` to the first one's; one frame or none is identical too."""
    first = F.element_at(hashes, 1)
    rest = F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1)))
    return F.when(F.size(hashes) <= 1, F.lit(True)).otherwise(F.coalesce(F.forall(rest, lambda h: distance(first, h) < limit), F.lit(False)))
