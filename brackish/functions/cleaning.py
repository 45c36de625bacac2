"""Column expressions that turn raw fields into null-safe numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """NaN and infinities become null, as every aggregate here expects."""
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def try_number(c: Column) -> Column:
    """Text to double; anything unreadable becomes null."""
    return finite(c.try_cast("double"))


def above_sentinel(c: Column, sentinel: float) -> Column:
    """Values at or below a missing-data sentinel become null."""
    number = try_number(c)
    return F.when(number > F.lit(float(sentinel)), number)


def divide(a: Column, b: Column) -> Column:
    """Null instead of an error where the divisor is zero."""
    return F.try_divide(a, b)


def pair_mean(a: Column, b: Column) -> Column:
    """Mean of the non-null members of a pair (edge values to cell centres)."""
    return F.coalesce((a + b) / 2.0, a, b)


def elevation_to_depth(elevation: Column) -> Column:
    """Positive-down depth: land is 0, missing stays null."""
    elevation = finite(elevation)
    return F.when(elevation < 0, -elevation).when(elevation.isNotNull(), F.lit(0.0))


def is_wet(elevation: Column) -> Column:
    return F.coalesce(finite(elevation) < 0, F.lit(False))


def log10_positive(c: Column) -> Column:
    return F.when(c > 0, F.log10(c))


def row_sum(columns: list[Column]) -> Column:
    """Sum over columns; null unless all are present."""
    return reduce(lambda a, b: a + b, columns)


def silt(mud: Column, clay: Column) -> Column:
    return F.when(mud >= clay, mud - clay)


def fractions_valid(
    gravel: Column, sand: Column, mud: Column, clay: Column, low: float = 95.0, high: float = 105.0
) -> Column:
    """Do the grain fractions close to a whole, with every class known and not negative?"""
    classes = [gravel, sand, clay, silt(mud, clay)]
    return F.coalesce(
        row_sum([gravel, sand, mud]).between(low, high)
        & reduce(lambda a, b: a & b, [c.isNotNull() & (c >= 0) for c in classes]),
        F.lit(False),
    )


def normalised_fraction(part: Column, classes: list[Column], valid: Column) -> Column:
    return F.when(valid, F.try_divide(part * 100.0, row_sum(classes)))
