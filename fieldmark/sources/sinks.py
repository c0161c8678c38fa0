"""Where tables go."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.fingerprint import added_up, fingerprint, part_fingerprints
from ..plans import fixed_values as fixed
from ..plans.surveys import point_table
from ..session import settle
from .readers import parquet_if_there

log = logging.getLogger(__name__)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table; partition a large one by what it is read by, such as the year."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, table: str, jdbc: dict[str, str] | None = None, order: Sequence[Column] = ()) -> None:
    """Replace a table: of the catalogue, or of a database if its options are given.

    With ``order`` it is laid out in that order, which is the last step before it is written.
    """
    df = df.orderBy(*order) if order else df
    try:
        if jdbc:
            df.write.format("jdbc").options(**jdbc, dbtable=table).mode("overwrite").save()
        else:
            df.write.mode("overwrite").saveAsTable(table)
    except Exception:
        log.exception("writing table %s failed", table)
        raise


def replace_tables(df: DataFrame, tables: list[str], jdbc: dict[str, str] | None = None, order: Sequence[Column] = ()) -> None:
    """The same rows under several names, computed once."""
    stored = settle(df)
    for table in tables:
        replace_table(stored, table, jdbc, order)


def store_changes(changes: DataFrame, path: str) -> None:
    """Snapshots as intervals, sorted by where they begin so that a reader of one year skips the rest."""
    changes.sortWithinPartitions("valid_from", "valid_to").write.mode("overwrite").parquet(path)


def publish_survey(sites: DataFrame, snapshots: DataFrame, survey: str, jdbc: dict[str, str] | None = None) -> None:
    """Sites with a point, and the yearly snapshots, as tables of the survey's name.

    The two surveys that report on countries have no points: all of their rows go.
    """
    on_countries = survey in (fixed.COUNTRY_SURVEY, fixed.REGIONAL_SURVEY)
    replace_table(sites if on_countries else point_table(sites), survey, jdbc)
    replace_table(snapshots, f"{survey}_snapshots", jdbc)


def publish_surveys(tables: dict[str, tuple[DataFrame, DataFrame]], jdbc: dict[str, str] | None = None) -> None:
    """Sites and snapshots of every survey, by its name."""
    for survey, (sites, snapshots) in tables.items():
        publish_survey(sites, snapshots, survey, jdbc)


def mirror_tables(spark: SparkSession, old_of_new: dict[str, str]) -> None:
    """Copy tables under the names they used to have."""
    for new, old in old_of_new.items():
        replace_table(spark.table(new), old)


def publish_if_changed(df: DataFrame, folder: str, version: str | None = None) -> str | None:
    """Write a new version of a table unless the last one holds the same rows.

    Returns the version written, or None.  A version's fingerprint, one row, is
    written after its table: a table without one is a version that did not come
    about.  Only the newest is compared.  Names are by UTC time and unique.
    """
    spark = df.sparkSession
    stored = settle(df)
    now = fingerprint(stored)
    marks = f"{folder}/_versions"
    published = parquet_if_there(spark, marks)
    if published is not None:
        latest = published.orderBy("version", ascending=False).limit(1)
        if not latest.join(now, ["n_rows", "content", "columns"]).isEmpty():
            return None
    version = version or _new_version()
    write_parquet(stored, f"{folder}/version={version}")
    now.withColumn("version", F.lit(version)).write.mode("append").parquet(marks)
    return version


def _new_version() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S_%f}_{uuid4().hex[:8]}"


def _manifest(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame | None:
    """The parts of a version, by default the newest, with their fingerprints and where each lies."""
    marks = parquet_if_there(spark, f"{folder}/_parts")
    if marks is None:
        return None
    newest = marks.agg(F.max("version")).scalar() if version is None else F.lit(version)
    return marks.filter(F.col("version") == newest)


def publish_parts_if_changed(df: DataFrame, folder: str, parts: Sequence[str], version: str | None = None) -> str | None:
    """Write the parts of a table that differ from those published last; the others stay where they are.

    A part is what has the same values in ``parts``.  Fingerprints add up, those of rows to
    that of a part and those of parts to that of the table.  If the table's is the same nothing is
    written; else parts are compared, and only rows of changed or new ones are written, into
    a folder of the new version.  The version's manifest, written last, names for every
    part the version that holds it; parts that are gone are not named.
    Returns the version written, or None.
    """
    spark = df.sparkSession
    stored = settle(df)
    now = settle(part_fingerprints(stored, parts))
    before = _manifest(spark, folder)
    known = now.withColumn("held_by", F.lit(None).cast("string"))
    if before is not None:
        if not added_up(before).join(added_up(now), ["n_rows", "content", "columns"]).isEmpty():
            return None
        held = before.select(F.struct(*now.columns).alias("__held"), "held_by")
        known = settle(now.join(held, F.struct(*now.columns) == F.col("__held"), "left").select(*now.columns, "held_by"))
    version = version or _new_version()
    changed = known.filter("held_by is null").select(F.struct(*parts).alias("__changed"))
    rows = stored.join(changed, F.struct(*parts) == F.col("__changed"), "left_semi")
    # one file for a part, several for a large one
    rows.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).parquet(f"{folder}/version={version}")
    described = {"held_by": F.coalesce("held_by", F.lit(version)), "version": F.lit(version), "schema": F.lit(df.schema.json())}
    known.withColumns(described).write.mode("append").parquet(f"{folder}/_parts")
    return version


def published_parts(spark: SparkSession, folder: str, parts: Sequence[str], version: str | None = None) -> DataFrame | None:
    """The table of a version that was published by parts, by default the newest."""
    manifest = _manifest(spark, folder, version)
    first = manifest.first() if manifest is not None else None
    if first is None:
        return None
    schema = T.StructType.fromJson(json.loads(first.schema))
    holders = [r.held_by for r in manifest.select("held_by").distinct().collect()]  # at most one for each version
    reader = spark.read.schema(schema.add("version", "string")).option("basePath", folder)
    stored = reader.parquet(*[f"{folder}/version={v}" for v in holders])
    wanted = manifest.select(F.struct(*parts, F.col("held_by").alias("version")).alias("__wanted"))
    return stored.join(wanted, F.struct(*parts, "version") == F.col("__wanted"), "left_semi").select(*[f.name for f in schema.fields if f.name != "version"])
