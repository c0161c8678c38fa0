"""Sums of floating-point numbers that do not depend on the order of addition.

A number is split, without error, into whole numbers of 26 bits, its *limbs*, one for each
of five weights.  Limbs are added as longs, which is exact and takes any order, blocks and
partial sums; only the finished sum becomes floating point again, rounded once.  So the
same rows give the same bits however Spark deals them out.

Bits under 2^-78 of a number are cut off, each number by itself, so the order still does not
matter.  A number or sum of 2^89 and above ends the job, and so does a sum of more
than 2^37 numbers.  Infinite and not-a-number entries are counted beside the limbs and decide
the sum as they do in floating point.  Nulls add nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS = 26
_WEIGHTS = (26, 0, -26, -52, -78)
_PARTS = [*[f"limb{i}" for i in range(len(_WEIGHTS))], "odd"]
#: what an entry counts that pulls a sum down; one that pulls it up counts 1, one that is no number both
_DOWN = 1 << 32


def is_floating(df: DataFrame, value: Column) -> bool:
    return isinstance(df.select(value.alias("v")).schema["v"].dataType, (T.DoubleType, T.FloatType))


def part_names(out: str) -> list[str]:
    """The columns that hold the parts of the number named ``out``."""
    return [f"__{out}_{part}" for part in _PARTS]


def parts_of(out: str, column: str) -> dict[str, str]:
    """SQL of the parts of a floating-point column, each to be summed; null for null."""
    v = f"`{column}`"
    finite = f"if(isnan({v}) or abs({v}) = double('inf'), 0d, {v})"
    # the remainder keeps the number's sign and the cast cuts towards zero: limbs of a negative number are negative
    limbs = [f"{finite} * {2.0 ** -_WEIGHTS[0]!r}d"] + [f"({finite} * {2.0**-w!r}d) % {2.0**_BITS!r}d" for w in _WEIGHTS[1:]]
    odd = f"case when isnan({v}) then {1 + _DOWN}L when {v} = double('inf') then 1L when {v} = double('-inf') then {_DOWN}L when {v} is not null then 0L end"
    return {name: f"cast({part} as bigint)" for name, part in zip(part_names(out), [*limbs, odd], strict=True)}


def part_sums(outs: Sequence[str]) -> list[Column]:
    """Aggregates of the parts of floating-point columns of these names."""
    return [F.expr(f"sum({part}) as `{name}`") for out in outs for name, part in parts_of(out, out).items()]


def joined(out: str) -> Column:
    """The number that the summed parts stand for, rounded once; null if nothing was summed.

    The limbs' values are added with what each addition loses carried along.
    """
    *limbs, odd = part_names(out)
    values = ", ".join(f"cast(`{name}` as double) * {2.0**w!r}d" for name, w in zip(limbs, _WEIGHTS, strict=True))
    longer, seen = "(s.sum + x)", "(s.sum + x - s.sum)"
    lost = f"s.lost + ((s.sum - ({longer} - {seen})) + (x - {seen}))"
    total = f"""aggregate(array({values}), named_struct('sum', 0d, 'lost', 0d),
        (s, x) -> named_struct('sum', {longer}, 'lost', {lost}), s -> s.sum + s.lost)"""
    return F.expr(
        f"""case when `{odd}` = 0 then {total} when `{odd}` >= {_DOWN} and `{odd}` % {_DOWN} > 0 then double('nan')
        when `{odd}` >= {_DOWN} then double('-inf') when `{odd}` > 0 then double('inf') end"""
    )


def sum_exactly(df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Grouped sums whose last bit is the same in any order."""
    summed = df.select(*keys, *[value.cast("double").alias(out) for out, value in values.items()]).groupBy(*keys).agg(*part_sums(list(values)))
    return summed.select(*keys, *[joined(out).alias(out) for out in values])
