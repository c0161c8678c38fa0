"""Targets against results, long and wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null
from ..operators.lookups import attach, first_match, the_only
from ..operators.reshape import pivot_years
from ..schema import fixed_table
from . import fixed_values as fixed


def layout(spark: SparkSession) -> DataFrame:
    """The report's lines in order: section, component and code."""
    lines = [
        (section, label, component, code)
        for section, label, components in fixed.REPORT_LAYOUT
        for component, codes in components
        for code in codes
    ]
    rows = [(i, *line) for i, line in enumerate(lines)]
    return fixed_table(
        spark, rows, "ord int, section string, section_label string, component string, indicator_code string"
    )


def spine(lines: DataFrame, years: tuple[int, ...] = fixed.REPORT_YEARS) -> DataFrame:
    """Each line for each country and year; regional codes for the top place only."""
    places = F.array(
        *[
            F.struct(F.lit(i).alias("country_ord"), F.lit(c).alias("country"), F.lit(k).alias("country_code"))
            for i, (c, k) in enumerate(fixed.REPORT_COUNTRIES)
        ]
    )
    per_place = lines.withColumn("p", F.explode(places)).select(*lines.columns, "p.*")
    regional = F.col("indicator_code").startswith("Reg")
    per_place = per_place.filter(~regional | (F.col("country") == fixed.TOP_PLACE))
    return per_place.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))


def _attach_only(df: DataFrame, right: DataFrame, on: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """Attach the one row of each key that the report asks for."""
    asked = df.select(*[F.col(k).alias(r) for k, r in on.items()]).distinct()
    wanted = right.join(asked, list(on.values()), "left_semi")
    return attach(df, the_only(wanted, list(on.values()), list(columns.values())), on, columns)


def reported_value(value: Column, cumulated: Column, code: Column) -> Column:
    """The value cumulated over the current project where there is one, but not for regional codes."""
    return F.when(cumulated.isNotNull() & ~code.startswith("Reg"), cumulated).otherwise(value)


def in_unit(amount: Column, unit: Column, is_value: bool) -> Column:
    """An amount in the unit it is shown in; percentages are only scaled for values."""
    shown = F.lower(unit)
    scaled = F.when(unit == fixed.REPORT_PERCENT_UNIT, amount * 100).otherwise(amount) if is_value else amount
    return (
        F.when(shown.contains("millions"), scaled / 1_000_000)
        .when(shown.contains("milliers"), scaled / 1_000)
        .otherwise(scaled)
    )


def attainment(value: Column, target: Column) -> Column:
    """Value over target; null without a value or with no or a zero target."""
    return F.when(value.isNotNull() & (target != 0), F.round(F.try_divide(value, target), 3))


def target_vs_result(
    targets: DataFrame,
    indicators: DataFrame,
    metadata: DataFrame,
    current_suffix: str,
    file_order: tuple[str, ...] = ("line",),
) -> DataFrame:
    """The long report: target, value and attainment per line, country and year.

    The unit of a code is that of its first target by ``file_order``, columns
    that give the targets their order.  A place and year found twice ends the job.
    """
    cumulated = f"cumulative_value_{current_suffix}"
    values = indicators.filter(F.col("level") <= 2).select(
        "indicator_code",
        "country",
        "year",
        nan_to_null(F.col("value")).alias("value"),
        nan_to_null(F.col(cumulated)).alias("cumulated"),
    )
    units = first_match(targets, ["Code"], file_order)
    code = F.col("indicator_code")

    out = spine(layout(targets.sparkSession))
    out = _attach_only(out, metadata, {"indicator_code": "code"}, {"label": "designation"})
    out = attach(out, units, {"indicator_code": "Code"}, {"unit": "unite"})
    out = _attach_only(
        out,
        values,
        {"indicator_code": "indicator_code", "country": "country", "year": "year"},
        {"plain": "value", "cumulated": "cumulated"},
    )
    out = _attach_only(
        out,
        targets,
        {"indicator_code": "Code", "country_code": "Pays", "year": "année"},
        {"target_raw": "valeur"},
    )
    value = reported_value(F.col("plain"), F.col("cumulated"), code)
    out = out.withColumns(
        {
            "value": in_unit(value, F.col("unit"), is_value=True),
            "target": in_unit(F.col("target_raw"), F.col("unit"), is_value=False),
        }
    )
    return out.withColumn("ratio", attainment(F.col("value"), F.col("target"))).drop(
        "plain", "cumulated", "target_raw"
    )


def wide_report(long: DataFrame, years: tuple[int, ...] = fixed.REPORT_YEARS) -> DataFrame:
    """One line per code and country, three columns per year."""
    rows = [
        "ord", "section", "section_label", "component", "indicator_code", "label", "unit", "country_ord", "country",
    ]
    wide = pivot_years(long, rows, "year", years, ["target", "value", "ratio"])
    return wide.orderBy("ord", "country_ord")
