"""Scalar expressions shared by the operators; all run inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_MILES = 3959.0


def flag(condition: Column) -> Column:
    """A condition that is FALSE, not NULL, where its inputs are missing."""
    return F.coalesce(condition, F.lit(False))


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance. The root is clamped to 1: rounding above it would give NaN for antipodes. NULL where a coordinate is."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2))
    chord = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_RADIUS_MILES * F.asin(F.when(chord > 1, F.lit(1.0)).otherwise(F.sqrt(chord)))


def leading_digit(value: Column) -> Column:
    """First character of |value| as an int when it is 1 to 9, else NULL (so 0.50 and NaN have none)."""
    digit = F.substring(F.abs(value).cast("string"), 1, 1).try_cast("int")
    return F.when(digit.between(1, 9), digit)


def charge_similarity(a: Column, b: Column, *, absolute: bool = False) -> Column:
    """1 - |a-b| / greatest(a, b); NULL when the larger is zero."""
    a, b = a.cast("double"), b.cast("double")
    if absolute:
        a, b = F.abs(a), F.abs(b)
    return 1.0 - F.try_divide(F.abs(a - b), F.greatest(a, b))
