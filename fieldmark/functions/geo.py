"""Distances and cells on the globe."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: earth radius in km.
EARTH_RADIUS_KM = 6372.8


def _chord(dlat: Column, dlon: Column, cosines: Column) -> Column:
    return F.pow(F.sin(F.radians(dlat) / 2), 2) + cosines * F.pow(F.sin(F.radians(dlon) / 2), 2)


def _arc_km(chord: Column) -> Column:
    # rounding may carry the chord of antipodes past 1, where asin is no number
    return F.lit(2 * EARTH_RADIUS_KM) * F.nanvl(F.asin(F.sqrt(chord)), F.lit(math.pi / 2))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance between two points in degrees."""
    cosines = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return _arc_km(_chord(lat2 - lat1, lon2 - lon1, cosines))


def unit_vector(lat: Column, lon: Column) -> Column:
    """The point on the unit sphere, as a struct ``x, y, z``."""
    phi, theta = F.radians(lat), F.radians(lon)
    return F.struct(
        (F.cos(phi) * F.cos(theta)).alias("x"), (F.cos(phi) * F.sin(theta)).alias("y"), F.sin(phi).alias("z")
    )


def within_km(a: dict[str, Column], b: dict[str, Column], limit_km: float) -> Column:
    """Whether two points are at most ``limit_km`` apart by :func:`haversine_km`.

    A point is ``lat, lon, at``, the last its unit vector.  Straight distances
    decide, which takes no trigonometry per pair; only where they come closer to
    the limit than rounding could carry them is the great circle worked out.
    """
    straight = (2 * math.sin(min(limit_km / (2 * EARTH_RADIUS_KM), math.pi / 2))) ** 2
    margin = 1e-6
    gap = F.lit(0.0)
    for axis in "xyz":
        step = a["at"][axis] - b["at"][axis]
        gap = gap + step * step
    return (
        F.when(gap <= straight * (1 - margin), F.lit(True))
        .when(gap > straight * (1 + margin), F.lit(False))
        .otherwise(haversine_km(a["lat"], a["lon"], b["lat"], b["lon"]) <= limit_km)
    )


#: what is known of a box of points: its sides in degrees, and the range of the cosine of its latitudes
BOX = ("south", "north", "west", "east", "cos_low", "cos_high")


def box_of(lat: Column, lon: Column) -> dict[str, Column]:
    """Aggregations that make the box of a group of points; no box may span a hemisphere."""
    south, north = F.min(lat), F.max(lat)
    far = F.greatest(F.abs(south), F.abs(north))
    near = F.greatest(F.lit(0.0), south, -north)
    return {
        "south": south,
        "north": north,
        "west": F.min(lon),
        "east": F.max(lon),
        "cos_low": F.cos(F.radians(far)),
        "cos_high": F.cos(F.radians(near)),
    }


def boxes_within_km(a: dict[str, Column], b: dict[str, Column], limit_km: float) -> tuple[Column, Column]:
    """Whether surely all, and whether possibly any, points of two boxes are within a distance.

    The nearest two points are no nearer than the gap between the boxes at the
    smallest cosine of latitude, the farthest no farther than the widest span at
    the largest.  For the sine of a half angle h this takes ``h² (1 - h²/3)`` from
    below and ``h²`` from above, and a margin keeps rounding out of both answers.
    """
    zero, half = F.lit(0.0), math.pi / 360
    gap_lat = F.greatest(zero, a["south"] - b["north"], b["south"] - a["north"])
    gap_lon = F.greatest(zero, a["west"] - b["east"], b["west"] - a["east"])
    span_lat = F.greatest(a["north"] - b["south"], b["north"] - a["south"])
    span_lon = F.greatest(a["east"] - b["west"], b["east"] - a["west"])
    cos_low, cos_high = F.least(a["cos_low"], b["cos_low"]), F.greatest(a["cos_high"], b["cos_high"])

    def above(angle: Column) -> Column:
        return F.pow(angle * half, 2)

    def below(angle: Column) -> Column:
        return F.pow(angle * half, 2) - F.pow(angle * half, 4) / 3

    limit = math.sin(min(limit_km / (2 * EARTH_RADIUS_KM), math.pi / 2)) ** 2
    margin = 1e-8
    return (
        above(span_lat) + F.pow(cos_high, 2) * above(span_lon) <= limit * (1 - margin),
        below(gap_lat) + F.pow(cos_low, 2) * below(gap_lon) <= limit * (1 + margin),
    )


def cell_label(lat: Column, lon: Column, digits: int = 2) -> Column:
    """Name of the rounded cell a point lies in; null without a full point."""
    return F.concat(
        F.round(lat, digits).cast("string"), F.lit("_"), F.round(lon, digits).cast("string")
    )


def wkt_point(lon: Column, lat: Column) -> Column:
    """``POINT (lon lat)``, null where a coordinate is missing."""
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
