"""Rounding and exact sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed point for sums of doubles.
FIXED = T.DecimalType(38, 18)


def round_double(value: Column, digits: int) -> Column:
    """Round a double half away from zero, scaling in binary.

    ``F.round`` on a double goes through its decimal text, which makes 1.01 of
    1.005; scaling first gives 1.0, the value of the double itself.
    """
    scale = 10.0**digits
    return F.round(value * F.lit(scale)) / F.lit(scale)


def exact_sum(value: Column) -> Column:
    """Sum of doubles or floats that does not depend on the order in which rows are merged.

    Each addend becomes the decimal that it is printed as, of 18 places, and decimals add up
    exactly; only the total is a double again. Good for totals below 10**20; a larger one, or an addend that is no
    number, raises.
    """
    return F.sum(value.cast("double").cast(FIXED)).cast("double")


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` to two places, NULL where the whole is 0 or NULL."""
    return F.when(
        F.coalesce(whole, F.lit(0.0)) != 0,
        round_double(part.cast("double") / whole * 100, 2),
    )
