"""Where tables come from.  Nothing is inferred where the columns are known."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import last_segment
from ..operators.dedup import snapshot_of, snapshots_of
from ..operators.lookups import any_of
from ..operators.ordered import blocks_of, forward_fill, running_sum
from ..plans import fixed_values as fixed
from ..plans.indicators import history_facts
from ..schema import null_empty_structs


def parquet_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where there is nothing at the path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def survey_tables(spark: SparkSession, folder: str, names: Sequence[str] = fixed.SURVEYS) -> dict[str, DataFrame]:
    """The survey tables of a folder, one Parquet table each; absent ones are left out."""
    found = {n: parquet_if_there(spark, f"{folder}/{n}.parquet") for n in names}
    return {n: df for n, df in found.items() if df is not None}


def csv_text(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """A CSV file with a header, every column as text; a missing file is an error.

    ``line_breaks`` is for files with line breaks inside cells, which one task must
    read as a whole; other files are read in pieces.
    """
    return spark.read.option("header", True).option("multiLine", line_breaks).option("escape", '"').csv(path)


#: bytes of a file that one block of the line count covers
_BLOCK_BYTES = 1 << 24


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _header(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Names in the first record of a CSV file, and how many lines it takes."""
    taken: list[str] = []
    for row in spark.read.text(path).head(100):
        taken.append(row.value)
        if sum(line.count('"') for line in taken) % 2 == 0:
            break
    record = "\n".join(taken).removeprefix("\ufeff")
    return next(csv.reader([record + "\n"] if "\n" not in record else record.splitlines(True)), []), len(taken)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``csv_text`` of one file, with ``line``, where a record begins, in the order of the file.

    The file is read in pieces, line breaks inside cells included.  Lines and quotation
    marks are counted for each piece and summed over the pieces before it: that numbers the
    lines and tells which begin inside a cell, and those join the record that they go on.
    A line break inside a cell becomes a line feed.
    """
    names, head = _header(spark, path)
    at = F.col("_metadata.file_block_start").alias("at")
    lines = spark.read.text(path).select("value", at, F.monotonically_increasing_id().alias("pos"))
    counted = running_sum(
        lines, [], ["at", "pos"], {"line": F.lit(1).cast("long"), "marks": _quotes(F.col("value")).cast("long")}, [blocks_of(F.col("at"), _BLOCK_BYTES)]
    )
    inside = (F.col("marks") - _quotes(F.col("value"))) % 2 == 1
    begun = counted.withColumn("record", F.when(~inside, F.col("line")))
    placed = forward_fill(begun, [], ["line"], ["record"], [blocks_of(F.col("line"))])
    record = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n")
    records = placed.filter((F.col("record") > head) & F.col("record").isNotNull()).groupBy("record").agg(record.alias("text"))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    cells = F.from_csv("text", schema, {"escape": '"', "multiLine": "true"})
    return records.filter(F.trim("text") != "").select(cells.alias("cells"), F.col("record").alias("line")).select("cells.*", "line")


def history(spark: SparkSession, path: str, project: str) -> DataFrame:
    """The history file, as facts of the previous project, in the order of its lines."""
    return history_facts(numbered_lines(spark, path), project)


def indicator_metadata(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """The indicator metadata file: codes, names, units and notes, old and new."""
    return csv_text(spark, path, line_breaks)


def report_targets(spark: SparkSession, path: str) -> DataFrame:
    """The targets file of the report, with year and value as numbers and ``line``, its order."""
    return numbered_lines(spark, path).withColumns(
        {"année": F.col("année").cast("int"), "valeur": F.col("valeur").try_cast("double")}
    )


def official_results(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """Official results with a constant column that says where they come from."""
    return spark.read.parquet(path).withColumn("data_source", F.lit(tag))


def snapshots(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Snapshots out of stored changes: those of one year, of which the scan takes only rows that hold then, or all years laid out."""
    changes = spark.read.parquet(path)
    if year is None:
        return snapshots_of(changes)
    return snapshot_of(changes, year).drop("valid_from", "valid_to").withColumn("over_year", F.lit(year))


def cell_grid(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A sheet as a grid of text cells ``column_1..n`` with ``row_idx`` from 0.

    A Parquet grid holds these columns.  A CSV grid has no header and carries the
    row number as its first field: lines of a file that is read in pieces have
    no order of their own.
    """
    if file_format == "parquet":
        return spark.read.parquet(path)
    raw = spark.read.option("header", False).option("escape", '"').csv(path)
    cells = [F.col(c).alias(f"column_{i}") for i, c in enumerate(raw.columns[1:], start=1)]
    return raw.select(F.col(raw.columns[0]).cast("long").alias("row_idx"), *cells)


#: columns every exported submission has, though perhaps always empty
_ALWAYS = ("_validation_status", "_geolocation", "_attachments")


def submissions(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Exported submissions, one JSON object per line; empty objects become null text.

    Without a schema Spark reads the file once more to find the questions, and
    leaves out a column that only ever holds empty objects: it is put back.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = null_empty_structs(reader.json(path))
    absent = [c for c in _ALWAYS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


_FORM = "content struct<survey:array<struct<name:string,type:string,label:array<string>>>>"


def form_fields(spark: SparkSession, path: str) -> DataFrame:
    """The questions of a form definition: name, type and first label, in order."""
    form = spark.read.schema(_FORM).option("multiLine", True).json(path)
    return form.select(F.posexplode("content.survey").alias("position", "q")).select(
        "position",
        F.col("q.name").alias("name"),
        F.col("q.type").alias("type"),
        F.get(F.col("q.label"), F.lit(0)).alias("label"),
    ).filter(F.col("name").isNotNull())


def files(spark: SparkSession, folder: str, extensions: Sequence[str] = fixed.PICTURE_EXTENSIONS) -> DataFrame:
    """Paths and names of the files with one of the extensions, in any case; contents are not read."""
    listing = spark.read.format("binaryFile").load(folder).select("path")
    wanted = any_of([F.lower("path").endswith(f".{e}") for e in extensions])
    return listing.filter(wanted).withColumn("file_name", last_segment(F.col("path")))
