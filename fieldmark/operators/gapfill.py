"""Rows for the years and places nothing was reported for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import VALUE, align
from .dedup import keep_first
from .lookups import every_pair
from .rollup import TOP_PLACE

# The first year of the spine, and the last one of the previous project.
FIRST_YEAR = 2021
LAST_PREVIOUS_YEAR = 2021

_ORDER = ("date", "country", "region", "level")


def _codes(df: DataFrame) -> DataFrame:
    """Each code with its attributes, from its first row, and its deepest level."""
    first = F.struct(*_ORDER, "indicator_name", "unit")
    return (
        df.filter(F.col("indicator_code").isNotNull())
        .groupBy("indicator_code")
        .agg(
            F.min_by(F.struct("indicator_name", "unit", "indicator_changed"), first).alias("a"),
            F.max("level").alias("deepest"),
        )
        .select("indicator_code", "a.*", "deepest")
    )


def _places(df: DataFrame, top_place: str) -> DataFrame:
    """Codes, with their attributes, and the places each should have rows for; every pair once."""
    codes = _codes(df)
    countries = df.filter(F.col("level") == 2).select("country").distinct()
    regions = (
        df.filter(F.col("region").isNotNull() & (F.col("region") != ""))
        .select("indicator_code", "country", "region")
        .distinct()
    )
    none = F.lit(None).cast("string")
    top = codes.select("*", F.lit(1).alias("level"), F.lit(top_place).alias("country"), none.alias("region"))
    below_top = countries.filter(~F.col("country").eqNullSafe(top_place))
    national = every_pair(codes.filter("deepest >= 2"), below_top).select(
        *codes.columns, F.lit(2).alias("level"), "country", none.alias("region")
    )
    regional = (
        codes.filter("deepest >= 3")
        .join(regions, "indicator_code")
        .join(countries, "country", "left_semi")
        .select(*codes.columns, F.lit(3).alias("level"), "country", "region")
    )
    return top.unionByName(national).unionByName(regional)


def missing_cells(
    df: DataFrame,
    previous: str,
    current: str,
    first_year: int = FIRST_YEAR,
    last_previous_year: int = LAST_PREVIOUS_YEAR,
    top_place: str = TOP_PLACE,
) -> DataFrame:
    """An empty row for each code, year and place that should have one and has none.

    The top place always; every country that has a country row, for codes that
    reach countries; the code's own regions in those countries, for codes that
    reach regions.  Years run from ``first_year`` to the last one in the table.

    Rows are made from the years that a code and place lack, so the product with
    the years is never laid out: one row is made for each gap and none for what is there.
    """
    last_year = df.agg(F.max("date")).scalar()
    there = (
        df.filter(F.col("indicator_code").isNotNull() & (F.col("date") >= first_year))
        .groupBy(F.struct("indicator_code", "country", "region").alias("__key"))
        .agg(F.collect_set("date").alias("__years"))
    )
    places = _places(df, top_place).withColumns({"__last": last_year, "__key": F.struct("indicator_code", "country", "region")})
    every_year = F.sequence(F.lit(first_year), F.col("__last"))
    lacking = F.array_except(every_year, F.coalesce("__years", F.array().cast("array<int>")))
    rows = (
        places.filter(F.col("__last") >= first_year)
        .join(there.withColumnRenamed("__key", "__there"), F.col("__key") == F.col("__there"), "left")
        .withColumn("date", F.explode(lacking))
        .withColumn("project", F.when(F.col("date") <= last_previous_year, previous).otherwise(current))
    )
    return align(rows, VALUE)


def gap_fill(
    df: DataFrame,
    previous: str,
    current: str,
    first_year: int = FIRST_YEAR,
    last_previous_year: int = LAST_PREVIOUS_YEAR,
    top_place: str = TOP_PLACE,
) -> DataFrame:
    """The table with its gaps as null rows; a row that is there stays.

    Rows are compared by code, year, country and region; of rows that share them the
    one of the highest place stays.  Rows without a code stay and get no spine.
    Both branches read ``df``: settle it if it is dear.
    """
    order = ["level", "project", "value", "numerator", "denominator", "indicator_name", "unit"]
    there = keep_first(align(df, VALUE), ["indicator_code", "date", "country", "region"], [F.col(c) for c in order])
    return there.unionByName(missing_cells(df, previous, current, first_year, last_previous_year, top_place))
