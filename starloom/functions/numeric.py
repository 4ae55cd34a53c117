"""Null-safe arithmetic, pay rules, buckets, distance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from starloom.functions.text import ColumnLike, as_column

# Fixed values of the great-circle formula.
EARTH_RADIUS_MILES = 3961
UNITS_PER_MILE = {"mi": 1.0, "km": 1.60934}


def _zero_for_null(c: ColumnLike) -> Column:
    return F.coalesce(as_column(c), F.lit(0))


def _operands(fields: list[ColumnLike]) -> list[Column]:
    if isinstance(fields, (str, Column)):
        raise TypeError("give one list of fields")
    return [_zero_for_null(f) for f in fields]


def safe_add(fields: list[ColumnLike]) -> Column:
    """Sum over a row with nulls as 0."""
    return reduce(lambda a, b: a + b, _operands(fields))


def safe_subtract(fields: list[ColumnLike]) -> Column:
    """First minus all others, left to right, nulls as 0."""
    return reduce(lambda a, b: a - b, _operands(fields))


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Null where the denominator is 0 (plain `/` raises in ANSI mode)."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def width_bucket(value: ColumnLike, low: ColumnLike, high: ColumnLike, buckets: int | Column) -> Column:
    """0 below `low`, `buckets + 1` at or above `high`, else 1..buckets."""
    ends = [as_column(c) if isinstance(c, (str, Column)) else F.lit(c) for c in (low, high)]
    n = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.width_bucket(as_column(value).cast("double"), *[e.cast("double") for e in ends], n.cast("bigint"))


def haversine(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, unit: str = "mi") -> Column:
    """Distance between two points on the globe in miles or kilometres."""
    if unit not in UNITS_PER_MILE:
        raise ValueError(f"unit must be one of {sorted(UNITS_PER_MILE)}, got {unit!r}")
    a, b, c, d = (as_column(x).cast("double") for x in (lat1, lon1, lat2, lon2))

    def half_chord(x: Column, y: Column) -> Column:
        return F.pow(F.sin(F.radians((y - x) / 2)), 2)

    inner = half_chord(a, c) + F.cos(F.radians(a)) * F.cos(F.radians(c)) * half_chord(b, d)
    return 2 * F.lit(EARTH_RADIUS_MILES) * F.asin(F.sqrt(inner)) * F.lit(UNITS_PER_MILE[unit])


def positive(c: ColumnLike) -> Column:
    """H4: zero, negative and missing pay are unknown."""
    c = as_column(c)
    return F.when(c > 0, c)


def midpoint(low: ColumnLike, high: ColumnLike) -> Column:
    """Mean of both bounds, else whichever is there."""
    low, high = as_column(low), as_column(high)
    return F.coalesce((low + high) / F.lit(2.0), low, high)
