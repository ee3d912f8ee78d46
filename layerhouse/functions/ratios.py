"""Guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_ratio(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """``top / bottom`` as double, 0 where the denominator is 0; null stays null.

    With ``digits`` the quotient is taken in decimals and rounded half up: 8716.47 / 14 is 622.605,
    which a double quotient puts just below the tie.
    """
    if digits is None:
        quotient = F.try_divide(top.cast("double"), bottom.cast("double"))
    else:
        exact = F.try_divide(top.cast("decimal(22,4)"), bottom.cast("decimal(22,4)"))
        quotient = F.round(exact, digits).cast("double")
    return F.when(bottom == 0, F.lit(0.0)).otherwise(quotient)


def mean_of(total: Column, count: Column) -> Column:
    """``total / count`` as double, null where the count is 0."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def clamp_count(value: Column) -> Column:
    """A non-negative 64-bit count; anything unreadable, negative or too large becomes 0."""
    number = value.try_cast("bigint")
    return F.when(number >= 0, number).otherwise(F.lit(0).cast("bigint"))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
