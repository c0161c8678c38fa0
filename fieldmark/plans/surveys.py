"""Raw submissions to standard survey tables, unique sites and yearly snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import wkt_point
from ..functions.nested import doubles_from_json, point_part, public_url, to_json_or_null
from ..operators.dedup import latest_per_key, snapshots_of, yearly_changes
from ..operators.near import near_duplicate_ids
from ..schema import name
from ..session import settle
from . import fixed_values as fixed


def standardise(df: DataFrame, survey: str, picture_prefix: str) -> DataFrame:
    """One survey with its standard columns, nested answers as JSON and public picture addresses."""
    added = {}
    kinds = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    status = kinds.get("_validation_status")
    if isinstance(status, T.StructType) and "label" in status.names:
        added["validation_status"] = F.col("_validation_status.label").cast("string")
    else:
        added["validation_status"] = F.lit(None).cast("string")
    if isinstance(kinds.get("_geolocation"), T.ArrayType):
        added["LATITUDE"] = point_part(F.col("_geolocation"), 0)
        added["LONGITUDE"] = point_part(F.col("_geolocation"), 1)
    else:
        added["LATITUDE"] = added["LONGITUDE"] = F.lit(None).cast("double")

    if survey == fixed.COUNTRY_SURVEY:
        added["level_2"] = name("DATE4")
    for level, question in enumerate(fixed.PLACE_QUESTIONS.get(survey, ()), start=2):
        added[f"level_{level}"] = name(question)
    for out, questions in (("STATE", fixed.STATE_QUESTION), ("PROGRESS", fixed.PROGRESS_QUESTION)):
        if questions.get(survey) in df.columns:
            added[out] = name(questions[survey])
    wide = df.withColumns(added)

    nested = (T.StructType, T.ArrayType, T.MapType)
    text = {
        f.name: to_json_or_null(name(f.name), f.dataType)
        for f in wide.schema.fields
        if isinstance(f.dataType, nested)
    }
    if survey in fixed.PICTURE_STEM:
        for letter in "abcd":
            question = fixed.PICTURE_STEM[survey] + letter
            if question in df.columns:
                text[question] = public_url(name(question), picture_prefix, fixed.PLACEHOLDER_PICTURE)
    return wide.withColumns(text) if text else wide


def transform_survey(
    df: DataFrame, survey: str, picture_prefix: str, row_id: str = "_id", max_km: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """All submissions with the id of their site, and the latest one of each site.

    The two surveys that report on countries have no sites: both tables are the
    standardised one.  ``row_id`` is unique and never null.
    """
    standard = standardise(df, survey, picture_prefix)
    if survey in (fixed.COUNTRY_SURVEY, fixed.REGIONAL_SURVEY):
        return standard, standard
    # only ids are stored; the wide rows are read where they are written
    narrow = standard.select(row_id, "LATITUDE", "LONGITUDE")
    ids = settle(near_duplicate_ids(narrow, row_id, "LATITUDE", "LONGITUDE", max_km).drop("LATITUDE", "LONGITUDE"))
    sites = standard.join(ids, row_id).select(*standard.columns, *[c for c in ids.columns if c != row_id])
    return sites, latest_per_key(sites, ["infrastructure_id"], "DATE", [row_id], place=[row_id])


def survey_changes(sites: DataFrame, row_id: str = "_id") -> DataFrame:
    """The latest submission of each site and year, with the years it holds for; what to store of snapshots."""
    return yearly_changes(sites, "infrastructure_id", "DATE", [row_id], place=[row_id])


def survey_snapshots(sites: DataFrame, row_id: str = "_id") -> DataFrame:
    """For every year, the latest submission of each site up to then."""
    return snapshots_of(survey_changes(sites, row_id))


def point_table(sites: DataFrame, column: str = "_geolocation") -> DataFrame:
    """Sites that have a point, with it as text."""
    point = doubles_from_json(F.col(column))
    geometry = wkt_point(F.get(point, F.lit(1)), F.get(point, F.lit(0)))
    return sites.withColumn("geometry", geometry).filter(F.col("geometry").isNotNull())
