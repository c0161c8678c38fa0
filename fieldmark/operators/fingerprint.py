"""A content hash of a table that does not depend on the order of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import name


def row_text(df: DataFrame) -> Column:
    """A row as text that tells names, types, values and nulls apart; columns by name."""

    def value(field: T.StructField) -> Column:
        column = name(field.name)
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            text = F.to_json(column, {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, T.BinaryType):
            text = F.hex(column)
        else:
            text = column.cast("string")
        # a value is told from null by its length in front, and from the next column's by it too
        shown = F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        return F.concat(F.lit(f"{field.name}={field.dataType.simpleString()}="), shown)

    return F.concat_ws(";", *[value(f) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def _number(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")


def _columns(df: DataFrame) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))


def part_fingerprints(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """One row for each value of ``parts``: number of rows, both sums of their hashes, and the columns with their types.

    Sums, so that equal rows do not cancel; as decimals, so that they cannot overflow.
    Partial sums are all that is shuffled.  Both halves of each row's MD5 are summed, 60
    bits of either.
    """
    digest = F.md5(row_text(df))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)")
    hashed = df.select(*[name(p) for p in parts], _number(digest, 1).alias("__h"), _number(digest, 17).alias("__i"))
    return hashed.groupBy(*[name(p) for p in parts]).agg(
        F.count(F.lit(1)).alias("n_rows"), total("__h").alias("high"), total("__i").alias("low"), F.lit(_columns(df)).alias("columns")
    )


def added_up(parts: DataFrame, columns: str | Column = "columns") -> DataFrame:
    """The fingerprint of a table from those of its parts."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").cast("string")
    known = F.max(columns) if isinstance(columns, str) else columns
    return parts.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.concat(total("high"), F.lit("-"), total("low")).alias("content"), known.alias("columns")
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: number of rows, the sum of their hashes, and the columns with their types."""
    return added_up(part_fingerprints(df, []), F.lit(_columns(df)))
