"""Values cumulated over the years, by unit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ieee_div, zero_if_null
from .override import OFFICIAL
from .rollup import FLAG_UNIT, RATIO_UNIT, SUM_UNITS

#: the running sums go on within these
KEY = ("cumulated_as", "level", "indicator_code", "country", "region")

_ORDER = (
    "date", "data_source", "project", "value", "numerator", "denominator", "indicator_name", "unit"
)


def _classed(df: DataFrame, previous: str, current: str) -> DataFrame:
    """Rows that are cumulated, with the way in which they are."""
    unit, project = F.col("unit"), F.col("project")
    in_levels = F.col("level").isin(1, 2, 3)
    way = (
        F.when(unit.isin(*SUM_UNITS) & in_levels, "count")
        .when((unit == RATIO_UNIT) & (((project == current) & in_levels) | (project == previous)), "ratio")
        .when(unit == FLAG_UNIT, "flag")
    )
    return df.withColumn("cumulated_as", way).filter(F.col("cumulated_as").isNotNull())


def cumulate(df: DataFrame, previous: str, current: str, official: str = OFFICIAL) -> DataFrame:
    """Adds ``cumulated_numerator``, ``cumulated_denominator``, ``cumulated_value`` and
    ``cumulated_value_current``.

    * values that add up: running sums over all years, and over the current
      project only (null for rows of the previous one); an official figure is
      cumulated already and stands for itself, but later years still add it;
    * percentages: current project only, running numerator over running
      denominator; rows of the previous project stay with nulls;
    * yes/no: the value itself.

    Other units vanish.  One pass serves all three, each with its own key class.
    """
    rows = _classed(df, previous, current)
    way, value = F.col("cumulated_as"), F.col("value")
    is_current = F.col("project") == current
    counted = F.when(way == "count", zero_if_null(value)).otherwise(0.0)
    in_ratio = (way == "ratio") & is_current
    # a key has a row or two per year, so it is a plain window: nothing can be hot here
    so_far = Window.partitionBy(*KEY).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    summed = {
        "__all": counted,
        "__current": F.when(is_current, counted),
        "__num": F.when(in_ratio, F.col("numerator")).cast("double"),
        "__den": F.when(in_ratio, F.col("denominator")).cast("double"),
    }
    rows = rows.withColumns({out: F.sum(F.coalesce(v, F.lit(0.0))).over(so_far) for out, v in summed.items()})
    fixed = F.col("data_source") == official
    ratio = ieee_div(F.col("__num"), F.col("__den"))
    is_previous = F.coalesce(F.col("project") == previous, F.lit(False))

    def by_way(for_counts):
        return (
            F.when((way == "count") & fixed, value)
            .when(way == "count", for_counts)
            .when(in_ratio, ratio)
            .when(way == "flag", value)
        )

    return rows.withColumns(
        {
            "cumulated_numerator": F.when(in_ratio, F.col("__num")),
            "cumulated_denominator": F.when(in_ratio, F.col("__den")),
            "cumulated_value": by_way(F.col("__all")),
            "cumulated_value_current": by_way(F.when(~is_previous, F.col("__current"))),
        }
    ).drop("__all", "__current", "__num", "__den", "cumulated_as")


def cumulate_counts(df: DataFrame, previous: str, current: str, official: str = OFFICIAL) -> DataFrame:
    return cumulate(df.filter(F.col("unit").isin(*SUM_UNITS)), previous, current, official)


def cumulate_ratios(df: DataFrame, previous: str, current: str) -> DataFrame:
    return cumulate(df.filter(F.col("unit") == RATIO_UNIT), previous, current)


def cumulate_flags(df: DataFrame, previous: str, current: str) -> DataFrame:
    return cumulate(df.filter(F.col("unit") == FLAG_UNIT), previous, current)
