"""Wide to long, long to wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import extract


def unpivot_ordered(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str, position: str
) -> DataFrame:
    """Wide to long, keeping each value column's place in the list.

    Ordering by ``position`` and then by the row reads the table column by column.
    """
    places = F.create_map(*[F.lit(x) for i, c in enumerate(values) for x in (c, i)])
    long = df.unpivot(list(ids), list(values), variable, value)
    return long.withColumn(position, F.try_element_at(places, F.col(variable)))


def year_in_name(column: Column) -> Column:
    """The four-digit year in a column's name."""
    return extract(column, r"(\d{4})").cast("int")


def pivot_years(
    df: DataFrame, rows: Sequence[str], year: str, years: Sequence[int], measures: Sequence[str]
) -> DataFrame:
    """Long to wide: one column per year and measure, named ``<year>_<measure>``.

    The years are given, so no job has to look for them first; a row of another year, or
    of none, ends the job, as it would be left out.
    """
    years = list(years)
    message = F.concat(F.lit("a row of another year: "), F.coalesce(F.col(year).cast("string"), F.lit("none")))
    known = F.when(F.col(year).isin(*years), F.col(year)).otherwise(F.raise_error(message).cast(df.schema[year].dataType))
    wide = df.withColumn(year, known).groupBy(*rows).pivot(year, years).agg(*[F.first(m).alias(m) for m in measures])
    if len(measures) == 1:
        for y in years:
            wide = wide.withColumnRenamed(str(y), f"{y}_{measures[0]}")
    return wide
