"""Column functions on half-open ranges [start, end)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """X5. The common length, 0 for none."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2))


def swapped(frame: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """F7. Coordinates in ascending order: those of negative frames are swapped."""
    return F.when(frame < 0, end).otherwise(start), F.when(frame < 0, start).otherwise(end)


def score_ratio(a: Column, b: Column) -> Column:
    """The larger over the smaller score, 0 if either is 0."""
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(F.greatest(a, b) / F.least(a, b))


def chunk_coordinates(strand: Column, qstart: Column, qend: Column, chunk_start: Column, last: Column) -> tuple[Column, Column]:
    """J4. Where a hit in a chunk lies on the parent; ``last`` is the chunk's length less one."""
    plus = strand == "+"
    return F.when(plus, qstart + chunk_start).otherwise(last - qend + chunk_start), F.when(plus, qend + chunk_start - 1).otherwise(last - qstart + chunk_start - 1)


def set_distance(a: Column, b: Column) -> Column:
    """X15. The least difference between members of two arrays of numbers."""
    return F.array_min(F.transform(a, lambda x: F.array_min(F.transform(b, lambda y: F.abs(x - y)))))


def overlap_range(s1: Column, e1: Column, s2: Column, e2: Column, least: int = 1) -> Column:
    """H1. The common range (start, end) if it has at least ``least`` places, else null; a negative ``least`` allows a gap, whose
    range has its end before its start."""
    s, e = F.greatest(s1, s2), F.least(e1, e2)
    return F.when(e - s >= least, F.struct(s.alias("start"), e.alias("end")))


def within_distance(a: Column, b: Column, most: int) -> Column:
    """X15. Whether two arrays of numbers have members at most so far apart."""
    return set_distance(a, b) <= most
