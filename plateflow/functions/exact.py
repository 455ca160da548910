"""Ratios and averages rounded half away from zero with integer arithmetic.

Dividing two decimals in Spark rounds once at the result scale and once more in
``round``. Here numerator and denominator are brought to integers, divided once,
and scaled back, so a published figure never depends on the order of rounding.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

WIDE = "decimal(38,0)"


def _integer(value: Column, scale: int) -> Column:
    scaled = value if scale == 0 else value * F.lit(10**scale)
    return scaled.cast(WIDE)


def ratio(num: Column, den: Column, places: int, *, num_scale: int = 0, den_scale: int = 0, times: int = 1) -> Column:
    """``round(times * num / den, places)`` as a decimal; NULL when ``den`` is 0 or NULL.

    ``num_scale`` and ``den_scale`` are the digits after the point of the inputs.
    """
    shift = den_scale + places - num_scale
    top = _integer(num, num_scale) * F.lit(times * 10 ** max(shift, 0)).cast(WIDE)
    bottom = F.nullif(_integer(den, den_scale) * F.lit(10 ** max(-shift, 0)).cast(WIDE), F.lit(0).cast(WIDE))
    two = F.lit(2).cast(WIDE)
    size = F.call_function(
        "div", (F.abs(top) * two + F.abs(bottom)).cast(WIDE), (F.abs(bottom) * two).cast(WIDE)
    )
    signed = F.when((top < 0) != (bottom < 0), -size).otherwise(size)
    if places == 0:
        return signed.cast("decimal(20,0)")
    return (signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(24,{places})")


def percent(part: Column, whole: Column, places: int, **scales: int) -> Column:
    """``part`` as a percentage of ``whole``."""
    return ratio(part, whole, places, times=100, **scales)


def growth(current: Column, previous: Column, places: int, scale: int = 0) -> Column:
    """Relative change from ``previous`` to ``current`` in percent."""
    return ratio(current - previous, previous, places, num_scale=scale, den_scale=scale, times=100)


def mean(value: Column, places: int, scale: int = 0) -> Column:
    """Average of an exact numeric column inside an aggregation."""
    return ratio(F.sum(value), F.count(value), places, num_scale=scale)


def half_up(value: Column, places: int) -> Column:
    """``round`` for a value that is already an exact decimal."""
    return F.round(value, places)


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row, as scalar subqueries."""
    return df.withColumns({name: one_row.select(name).scalar() for name in one_row.columns})
