"""Canonical schemas, and the casts that make tables fit them before a union."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

PLACE_COLUMNS = ("country", "region", "province", "commune", "localite", "coordinates")

#: one value of one indicator, as read from a survey or a history file
FACT = _schema(
    ("indicator_code", _S),
    ("date", _S),
    ("level", _I),
    ("country", _S),
    ("region", _S),
    ("province", _S),
    ("commune", _S),
    ("localite", _S),
    ("coordinates", _S),
    ("numerator", _D),
    ("denominator", _D),
    ("value", _D),
    ("project", _S),
    ("src_rank", _I),
    ("src_line", T.LongType()),
)

#: a fact with its metadata; ``date`` is now a year
VALUE = _schema(
    ("indicator_code", _S),
    ("indicator_name", _S),
    ("unit", _S),
    ("date", _I),
    ("project", _S),
    ("level", _I),
    ("country", _S),
    ("region", _S),
    ("numerator", _D),
    ("denominator", _D),
    ("value", _D),
    ("indicator_changed", _B),
)

#: ``VALUE`` plus where the figure comes from
SOURCED_VALUE = T.StructType(VALUE.fields + [T.StructField("data_source", _S, True)])


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table of fixed rows, part of the plan itself, so that Spark knows its size."""
    kinds = T.StructType.fromDDL(schema)
    table = pa.Table.from_pylist([dict(zip(kinds.names, row)) for row in rows])
    return spark.createDataFrame(table, schema=kinds)


def name(column: str) -> Column:
    """A column by its exact name, whatever signs the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def col_or_null(df: DataFrame, column: str, kind: T.DataType | str = "string") -> Column:
    """The column, or a typed null where this table does not have it."""
    return name(column) if column in df.columns else F.lit(None).cast(kind)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, cast; absent ones are typed nulls."""
    return df.select(
        *[col_or_null(df, f.name, f.dataType).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def union_aligned(tables: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Diagonal union: tables with other columns or types, under one schema.

    The casts come first on purpose: Spark's own widening of mixed types in a
    union (string with int, date or boolean) is not the one wanted here.
    """
    if not tables:
        raise ValueError("union_aligned needs at least one table")
    parts = [align(t, schema) for t in tables]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def null_empty_structs(df: DataFrame) -> DataFrame:
    """Columns of an empty struct type become null strings (Parquet refuses them)."""
    empty = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType) and not f.dataType.fields
    ]
    return df.withColumns({c: F.lit(None).cast("string") for c in empty}) if empty else df
