"""Rounding, ratios and means that give the same value in any row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int) -> Column:
    """Round the binary value half away from zero, as SQL engines on doubles do.

    ``F.round`` rounds the shortest decimal text instead: 1.005 gives 1.01
    there and 1.00 here.
    """
    unit = F.lit(float(10**digits))
    x = x.cast("double")
    return F.signum(x) * F.floor(F.abs(x) * unit + F.lit(0.5)) / unit


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``scale * part / whole`` in doubles; NULL when ``whole`` is zero."""
    return F.try_divide(F.lit(float(scale)) * part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole, 100.0)


def exact_mean(x: Column, digits: int) -> Column:
    """Mean of values that carry at most ``digits`` decimals.

    The sum runs over decimals, so partial sums can merge in any order.
    """
    total = F.sum(x.cast(f"decimal(28,{digits})")).cast("double")
    return F.try_divide(total, F.count(x).cast("double"))
