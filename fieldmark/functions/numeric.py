"""Arithmetic with the null, zero and NaN rules the indicators need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INFINITY = float("inf")


def ieee_div(numerator: Column, denominator: Column) -> Column:
    """Division as floating point does it: 0/0 is NaN, x/0 is infinite, null stays null."""
    num, den = numerator.cast("double"), denominator.cast("double")
    by_zero = (
        F.when((num == 0) | F.isnan(num), F.lit(NAN))
        .when(num > 0, F.lit(INFINITY))
        .otherwise(F.lit(-INFINITY))
    )
    return (
        F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(den != 0, F.try_divide(num, den))
        .otherwise(by_zero)
    )


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def floor_bucket(value: Column, width: int) -> Column:
    """Lower edge of the bucket of ``width`` that holds a non-negative integer."""
    return value - F.pmod(value, F.lit(width))

