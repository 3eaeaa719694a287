"""Row-level numeric cleaning rules. NULL in, NULL out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def negative_to_null(c: Column) -> Column:
    return F.when(c >= 0, c)


def over_limit_to_null(c: Column, limit: float = 100.0) -> Column:
    return F.when(c <= limit, c)


def zero_to_null(c: Column) -> Column:
    return F.when(c != 0, c)


def sentinel_to_null(c: Column, sentinel: str = "Unknown") -> Column:
    return F.nullif(c, F.lit(sentinel))


def floor_whole(c: Column) -> Column:
    return F.floor(c)


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def age_from_year(c: Column, reference_year: int = 2024) -> Column:
    return F.lit(reference_year).cast("bigint") - F.floor(c)


def clip(c: Column, low, high) -> Column:
    """Cap to [low, high]; `greatest`/`least` would turn a NULL into a bound."""
    low, high = F.lit(low), F.lit(high)
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def is_not_whole(c: Column) -> Column:
    """True for fractional values and for missing ones."""
    return c.isNull() | (c % 1 != 0)
