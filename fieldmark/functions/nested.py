"""Structs, lists and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTACHMENTS = "array<struct<download_url:string,filename:string>>"


def point_part(geolocation: Column, position: int) -> Column:
    """Latitude (0) or longitude (1) of a point given as a list; a zero counts as missing."""
    complete = F.forall(geolocation, lambda e: e.isNotNull() & (e != 0))
    return F.when(complete, F.get(geolocation, F.lit(position))).cast("double")


def to_json_or_null(value: Column, kind: T.DataType) -> Column:
    """JSON text of a struct or list, null fields written out; an empty list is null."""
    text = F.to_json(value, {"ignoreNullFields": "false"})
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(value) > 0, text)
    return text


def doubles_from_json(text: Column) -> Column:
    return F.from_json(text, "array<double>")


def attachments_from_json(text: Column) -> Column:
    return F.from_json(text, ATTACHMENTS)


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def public_url(file: Column, prefix: str, placeholder: str = "placeholder.png") -> Column:
    """Where a picture is published; without a file, the placeholder's address."""
    present = file.isNotNull() & (file != "")
    return F.when(present, F.concat(F.lit(prefix), file)).otherwise(F.lit(prefix + placeholder))
