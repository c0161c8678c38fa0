"""Points on the map: near duplicates, and submissions of a site survey."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmark.functions.geo import cell_label, haversine_km
from fieldmark.operators.near import near_duplicate_ids, neighbour_counts
from fieldmark.plans.surveys import point_table, standardise, survey_changes, transform_survey
from fieldmark.session import scratch
from fieldmark.sources.readers import snapshots
from fieldmark.sources.sinks import store_changes

from .registry import query, table

RADIUS_KM = 0.4


def _spot(key):
    """A point from a key; the keys spread over a dozen cells."""
    lat = F.lit(14.0) + ((key * 7919) % 2003).cast("double") / F.lit(50021.0)
    lon = F.lit(-3.0) + ((key * 104729) % 1009).cast("double") / F.lit(50021.0)
    return lat, lon


def _spot_sql(key):
    return (
        f"14.0::DOUBLE + CAST(({key} * 7919) % 2003 AS DOUBLE) / 50021.0::DOUBLE",
        f"-3.0::DOUBLE + CAST(({key} * 104729) % 1009 AS DOUBLE) / 50021.0::DOUBLE",
    )


def customer_spots(spark, sf):
    """Customers with a point; all of one segment share one, those in debt have none."""
    shared = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(7)).otherwise(F.col("c_custkey"))
    lat, lon = _spot(shared)
    known = F.col("c_acctbal") >= 0
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(known, lat).alias("lat"), F.when(known, lon).alias("lon")
    )


_LAT, _LON = _spot_sql("CASE WHEN c_mktsegment = 'BUILDING' THEN 7 ELSE c_custkey END")
SPOTS_SQL = f"""
p AS (SELECT c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN {_LAT} END AS lat, CASE WHEN c_acctbal >= 0 THEN {_LON} END AS lon FROM customer)
"""


def hoods_sql(radius: float) -> str:
    """Neighbourhoods of ``p`` by comparing every pair of a cell."""
    distance = (
        "2 * 6372.8 * asin(sqrt(sin(radians(b.lat - a.lat) / 2) ** 2"
        " + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lon - a.lon) / 2) ** 2))"
    )
    return f"""
near AS (SELECT a.id AS i, b.id AS j FROM p a JOIN p b ON round(a.lat, 2) = round(b.lat, 2) AND round(a.lon, 2) = round(b.lon, 2)
         WHERE a.id = b.id OR {distance} <= {radius}),
hood AS (SELECT i, list_sort(list(j)) AS g FROM near GROUP BY i),
pos AS (SELECT g, min(i) AS pos FROM hood GROUP BY g),
ranked AS (SELECT i, g[1] AS lowest, pos FROM hood JOIN pos USING (g)),
common AS (SELECT n.i AS id, arg_max(lowest, pos) AS common_id FROM near n JOIN ranked r ON n.j = r.i GROUP BY n.i)
"""


@query(
    "geo_dedup_ids",
    f"WITH {SPOTS_SQL}, {hoods_sql(RADIUS_KM)} SELECT id AS c_custkey, coalesce(common_id, id) AS site_id FROM p LEFT JOIN common USING (id)",
)
def geo_dedup_ids(spark, sf):
    ids = near_duplicate_ids(customer_spots(spark, sf), "c_custkey", "lat", "lon", RADIUS_KM, out="site_id", cell=None)
    return ids.select("c_custkey", "site_id")


CHAIN_KM = 0.08


@query(
    "geo_components",
    f"""WITH RECURSIVE {SPOTS_SQL}, {hoods_sql(CHAIN_KM).replace("near AS (", "near AS MATERIALIZED (", 1)},
    reached(id, other) AS (SELECT i, j FROM near UNION SELECT r.id, n.j FROM reached r JOIN near n ON n.i = r.other)
    SELECT p.id AS c_custkey, coalesce(min(other), p.id) AS site_id FROM p LEFT JOIN reached USING (id) GROUP BY p.id""",
)
def geo_components(spark, sf):
    """Customers that neighbours of neighbours connect have one id."""
    spots = customer_spots(spark, sf)
    ids = near_duplicate_ids(spots, "c_custkey", "lat", "lon", CHAIN_KM, out="site_id", cell=None, mode="components")
    return ids.select("c_custkey", "site_id")


@query(
    "geo_neighbour_counts",
    f"WITH {SPOTS_SQL}, {hoods_sql(RADIUS_KM)} SELECT id AS c_custkey, coalesce(len(g) - 1, 0) AS n_neighbours FROM p LEFT JOIN hood ON i = id",
)
def geo_neighbour_counts(spark, sf):
    counted = neighbour_counts(customer_spots(spark, sf), "c_custkey", "lat", "lon", RADIUS_KM)
    return counted.select("c_custkey", "n_neighbours")


@query(
    "geo_distance_and_cell",
    f"""WITH {SPOTS_SQL} SELECT id AS c_custkey,
        round(2 * 6372.8 * asin(sqrt(sin(radians(14.0 - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(14.0)) * sin(radians(-3.0 - lon) / 2) ** 2)), 6) AS km,
        round(lat, 2) || '_' || round(lon, 2) AS cell FROM p""",
)
def geo_distance_and_cell(spark, sf):
    km = haversine_km(F.col("lat"), F.col("lon"), F.lit(14.0), F.lit(-3.0))
    return customer_spots(spark, sf).select(
        "c_custkey", F.round(km, 6).alias("km"), cell_label(F.col("lat"), F.col("lon")).alias("cell")
    )


# --- a site survey: every order is a submission about its customer's place -----------

SURVEY = "points_d_eau"
PREFIX = "https://pictures.example.org/"


def submissions(spark, sf):
    key = F.col("o_orderkey")
    place = F.when(F.col("o_custkey") % 7 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
    lat, lon = _spot(place)
    text = F.col("o_custkey").cast("string")
    named = F.concat(F.lit("photo-"), key.cast("string"), F.lit(".jpg"))
    orders = table(spark, sf, "orders")
    return orders.select(
        key.alias("_id"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("DATE"),
        *[F.concat(F.lit(f"{q}-"), text).alias(q) for q in ("LPE1", "LPE2", "LPE3", "LPE4", "LPE5")],
        F.struct(text.alias("x"), F.col("o_orderpriority").alias("y")).alias("LPE7"),
        F.col("o_orderpriority").alias("STPE5"),
        F.col("o_orderstatus").alias("STPE15"),
        F.when(key % 5 != 0, F.struct(F.col("o_orderstatus").alias("label"), key.alias("uid"))).alias("_validation_status"),
        F.when(key % 11 != 0, F.array(F.when(key % 13 != 0, lat).otherwise(0.0), lon)).alias("_geolocation"),
        F.when(key % 3 != 0, F.array(F.struct(F.concat(F.lit("http://x/"), named).alias("download_url"), named.alias("filename"))))
        .otherwise(F.array().cast("array<struct<download_url:string,filename:string>>"))
        .alias("_attachments"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, F.lit("")).otherwise(named).alias("LPE8a"),
        *[F.lit(None).cast("string").alias(f"LPE8{x}") for x in "bcd"],
    )


_PLAT, _PLON = _spot_sql("CASE WHEN o_custkey % 7 = 0 THEN 7 ELSE o_custkey END")
_HAS_POINT = "o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0"
SUBMISSIONS_SQL = f"""
s AS (SELECT *, o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
             CASE WHEN {_HAS_POINT} THEN {_PLAT} END AS lat, CASE WHEN {_HAS_POINT} THEN {_PLON} END AS lon,
             'photo-' || o_orderkey || '.jpg' AS photo FROM orders)
"""


@query(
    "survey_standardised",
    f"""WITH {SUBMISSIONS_SQL} SELECT id AS _id, CASE WHEN id % 5 <> 0 THEN o_orderstatus END AS validation_status, lat AS "LATITUDE", lon AS "LONGITUDE",
        'LPE1-' || o_custkey AS level_2, 'LPE5-' || o_custkey AS level_6, '{{"x":"' || o_custkey || '","y":"' || o_orderpriority || '"}}' AS level_7,
        o_orderpriority AS "STATE", o_orderstatus AS "PROGRESS",
        CASE WHEN id % 4 < 2 THEN '{PREFIX}placeholder.png' ELSE '{PREFIX}' || photo END AS "LPE8a", '{PREFIX}placeholder.png' AS "LPE8b",
        CASE WHEN id % 3 <> 0 THEN '[{{"download_url":"http://x/' || photo || '","filename":"' || photo || '"}}]' END AS _attachments,
        CASE WHEN id % 5 <> 0 THEN '{{"label":"' || o_orderstatus || '","uid":' || id || '}}' END AS _validation_status FROM s""",
)
def survey_standardised(spark, sf):
    return standardise(submissions(spark, sf), SURVEY, PREFIX).select(
        "_id", "validation_status", "LATITUDE", "LONGITUDE", "level_2", "level_6", "level_7", "STATE", "PROGRESS",
        "LPE8a", "LPE8b", "_attachments", "_validation_status",
    )


# submissions from one point have one neighbourhood, so the SQL compares points
_SITES_SQL = f"""
WITH {SUBMISSIONS_SQL}, p AS (SELECT min(id) AS id, lat, lon FROM s WHERE lat IS NOT NULL GROUP BY lat, lon), {hoods_sql(RADIUS_KM)},
sites AS (SELECT s.id AS _id, coalesce(common_id, s.id) AS infrastructure_id, day
          FROM s LEFT JOIN (SELECT lat, lon, common_id FROM p JOIN common USING (id)) c ON s.lat = c.lat AND s.lon = c.lon)
"""


@query(
    "survey_sites",
    f"""{_SITES_SQL} SELECT _id, infrastructure_id, day AS "DATE" FROM (SELECT *, row_number() OVER
        (PARTITION BY infrastructure_id ORDER BY day DESC NULLS FIRST, _id DESC) AS rn FROM sites) WHERE rn = 1""",
)
def survey_sites(spark, sf):
    _, latest = transform_survey(submissions(spark, sf), SURVEY, PREFIX, max_km=RADIUS_KM)
    return latest.select("_id", "infrastructure_id", "DATE")


@query(
    "survey_snapshots",
    f"""{_SITES_SQL}, years AS (SELECT unnest(generate_series((SELECT min(year(day)) FROM sites), (SELECT max(year(day)) FROM sites))) AS y)
        SELECT _id, infrastructure_id, CAST(y AS INTEGER) AS over_year FROM (SELECT *, row_number() OVER
        (PARTITION BY infrastructure_id, y ORDER BY day DESC, _id DESC) AS rn FROM sites JOIN years ON year(day) <= y) WHERE rn = 1""",
)
def snapshots_of_survey(spark, sf):
    """Stored as intervals and read back: a row for each change, years laid out by the reader."""
    sites, _ = transform_survey(submissions(spark, sf), SURVEY, PREFIX, max_km=RADIUS_KM)
    folder = scratch(spark)
    changes = survey_changes(sites.select("_id", "infrastructure_id", "DATE"))
    store_changes(changes, folder)
    return snapshots(spark, folder).select("_id", "infrastructure_id", "over_year")


@query(
    "point_layer",
    """SELECT c_custkey, 'POINT (' || CAST(CAST(c_nationkey AS DOUBLE) / 8 AS VARCHAR) || ' ' || CAST(CAST(c_custkey % 90 AS DOUBLE) AS VARCHAR) || ')' AS geometry
       FROM customer WHERE c_acctbal >= 0""",
)
def point_layer(spark, sf):
    lat = (F.col("c_custkey") % 90).cast("double").cast("string")
    lon = (F.col("c_nationkey").cast("double") / 8).cast("string")
    text = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("["), lat, F.lit(","), lon, F.lit("]")))
    sites = table(spark, sf, "customer").select("c_custkey", text.alias("_geolocation"))
    return point_table(sites).select("c_custkey", "geometry")
