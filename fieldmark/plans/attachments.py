"""Which pictures are still to be fetched, and which to be published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nested import attachments_from_json, last_segment
from ..operators.lookups import not_among
from . import fixed_values as fixed


def attachment_list(df: DataFrame, column: str = "_attachments") -> DataFrame:
    """Address and file name of every picture in a table's JSON lists, placeholders aside."""
    item = F.explode(attachments_from_json(F.col(column)))
    url = F.col("a.download_url")
    return (
        df.select(item.alias("a"))
        .filter(url.isNotNull() & (url != "") & ~url.contains(fixed.PLACEHOLDER_PICTURE))
        .select(url.alias("download_url"), last_segment(F.col("a.filename")).alias("file_name"))
    )


def fetch_manifest(surveys: dict[str, DataFrame], present: DataFrame) -> DataFrame:
    """Pictures of all surveys that are not among the files present (``file_name``)."""
    lists = [attachment_list(df).withColumn("survey", F.lit(survey)) for survey, df in surveys.items()]
    everything = reduce(DataFrame.unionByName, lists)
    return not_among(everything, present, {"file_name": "file_name"})


def publish_manifest(files: DataFrame, published: DataFrame) -> DataFrame:
    """Picture files (``path``) whose name is not among the published ones (``file_name``)."""
    extension = F.lower(F.element_at(F.split("file_name", r"\."), -1))
    pictures = files.withColumn("file_name", last_segment(F.col("path"))).filter(
        F.col("file_name").contains(".") & extension.isin(*fixed.PICTURE_EXTENSIONS)
    )
    return not_among(pictures, published, {"file_name": "file_name"})
