"""Surveys, history, metadata and official figures to the published indicator table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lookup import relabel
from ..functions.text import contains_any_case, january_first, year_of_text
from ..operators.cumulate import cumulate
from ..operators.gapfill import FIRST_YEAR, LAST_PREVIOUS_YEAR, gap_fill
from ..operators.lookups import attach
from ..operators.override import override
from ..operators.rollup import rollup
from ..operators.spec import Indicator, compute
from ..schema import FACT, VALUE, align, union_aligned
from ..session import settle
from . import fixed_values as fixed
from .catalogue import DEFINITIONS, SURVEYS


# Fixed value: the order of the published table.
PUBLISHED_ORDER = ("indicator_code", "country", "region", "year")


@dataclass(frozen=True)
class Projects:
    """Labels of the previous project, which only left a history, and of the current one."""

    previous: str = "previous"
    current: str = "current"


def history_facts(raw: DataFrame, project: str) -> DataFrame:
    """Values of the previous project: ``Code, année, Pays, valeur`` to facts.

    Values of the codes that are percentages become shares.  ``line``, if there, is
    the order of the file.
    """
    line = F.col("line").cast("long") if "line" in raw.columns else F.lit(None).cast("long")
    value = F.col("valeur").cast("double")
    return raw.select(
        F.col("Code").alias("indicator_code"),
        january_first(F.col("année")).alias("date"),
        F.when(F.col("Pays") == "REGIONAL", 1).otherwise(2).alias("level"),
        relabel(F.col("Pays"), fixed.COUNTRY_OF_CODE).alias("country"),
        F.lit(project).alias("project"),
        F.when(F.col("Code").isin(*fixed.HISTORY_PERCENT_CODES), value / 100).otherwise(value).alias("value"),
        line.alias("src_line"),
    )


def combine_indicators(
    tables: dict[str, DataFrame],
    history: DataFrame | None,
    projects: Projects = Projects(),
    definitions: tuple[Indicator, ...] = DEFINITIONS,
) -> DataFrame:
    """Facts of all surveys after those of the history."""
    facts = compute(tables, SURVEYS, definitions, projects.current)
    if history is not None:
        facts.insert(0, history.withColumn("src_rank", F.lit(0)))
    if not facts:
        raise ValueError("neither surveys nor history given")
    return union_aligned(facts, FACT)


def join_metadata(facts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Facts under their present code, with name, unit, year and the changed flag.

    ``metadata`` has ``code_old, code_new, designation, unit, note``.  A code it
    does not know becomes null.
    """
    joined = attach(
        facts.withColumnRenamed("indicator_code", "code_old"),
        metadata,
        {"code_old": "code_old"},
        {"indicator_code": "code_new", "indicator_name": "designation", "unit": "unit", "note": "note"},
    )
    changed = F.coalesce(contains_any_case(F.col("note"), *fixed.NOTES_CHANGED), F.lit(False))
    return joined.withColumns({"date": year_of_text(F.col("date")), "indicator_changed": changed})


def metadata_projection(metadata: DataFrame) -> DataFrame:
    """The columns of the metadata file that facts are joined with."""
    return metadata.select(
        F.col("code").alias("code_old"),
        F.col("code_v2").alias("code_new"),
        F.col("designation_v2").alias("designation"),
        F.col("unite_v2").alias("unit"),
        "note",
    )


def publish_projection(df: DataFrame, current_suffix: str) -> DataFrame:
    """The published columns; those of the current project carry its suffix."""
    return df.select(
        "indicator_code",
        "indicator_name",
        "unit",
        F.col("date").alias("year"),
        january_first(F.col("date")).alias("date"),
        "project",
        "level",
        "country",
        "region",
        "numerator",
        "denominator",
        "value",
        F.col("cumulated_numerator").alias("cumulative_numerator"),
        F.col("cumulated_denominator").alias("cumulative_denominator"),
        F.col("cumulated_value").alias("cumulative_value"),
        F.col("cumulated_value_current").alias(f"cumulative_value_{current_suffix}"),
        "indicator_changed",
    )


def complete_values(
    rolled: DataFrame,
    official: DataFrame,
    projects: Projects,
    first_year: int = FIRST_YEAR,
    last_previous_year: int = LAST_PREVIOUS_YEAR,
) -> DataFrame:
    """Rolled-up values without gaps, under the official figures, cumulated and published.

    Official figures come after the gap fill, so they are never rolled up.
    ``rolled`` is read several times for the dimensions of the gap fill.  The figures
    are stored, as the override reads them for each of its keys.
    """
    complete = gap_fill(
        rolled, projects.previous, projects.current, first_year, last_previous_year, fixed.TOP_PLACE
    )
    figures = settle(align(official.drop("date").withColumnRenamed("year", "date"), VALUE))
    merged = settle(override(complete, figures))
    cumulated = cumulate(merged, projects.previous, projects.current)
    return publish_projection(cumulated, projects.current)


def indicator_table(
    tables: dict[str, DataFrame],
    history: DataFrame | None,
    metadata: DataFrame,
    official: DataFrame,
    projects: Projects = Projects(),
    definitions: tuple[Indicator, ...] = DEFINITIONS,
) -> DataFrame:
    """The whole job; ``PUBLISHED_ORDER`` is how the table is laid out when it is written.

    Facts are not stored: the rollup reads them once and stores what it makes of
    them.  The rolled-up table is stored before the gap fill, which reads it for its dimensions.
    """
    facts = combine_indicators(tables, history, projects, definitions)
    valued = join_metadata(facts, metadata_projection(metadata))
    rolled = settle(rollup(valued.select(*VALUE.names, "src_rank", "src_line"), top_place=fixed.TOP_PLACE))
    return complete_values(rolled, official, projects)


def table_counts(df: DataFrame) -> DataFrame:
    """Number of rows and of different codes, for the log of a run."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("indicator_code").alias("n_codes")
    )
