"""Lookups and set comparisons between tables.

No join here carries a broadcast hint.  Spark broadcasts a side when its size,
estimated or measured at run time, is under the session's threshold, and sorts
and merges otherwise; a hot key is then split by the skew-join rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(
    left: DataFrame, right: DataFrame, on: dict[str, str], columns: dict[str, str]
) -> DataFrame:
    """Left join on equal keys; ``columns`` maps new names to columns of ``right``.

    Several matches repeat the row, no match leaves nulls, null keys match nothing.
    """
    side = right.select(
        *[F.col(r).alias(f"__k{i}") for i, r in enumerate(on.values())],
        *[F.col(src).alias(out) for out, src in columns.items()],
    )
    match = [left[k] == side[f"__k{i}"] for i, k in enumerate(on)]
    joined = left.join(side, match, "left")
    return joined.select(*[c for c in left.columns if c not in columns], *columns)


def first_match(right: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by file order, ready to be attached."""
    from .dedup import keep_first

    return keep_first(right, keys, [F.col(c) for c in order])


def the_only(right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key, ready to be attached; a key found twice ends the job."""
    message = F.concat(F.lit("more than one row for "), F.to_json(F.struct(*keys)))
    counted = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*columns)).alias("__row")
    )
    checked = F.when(F.col("__n") == 1, F.col("__row")).otherwise(
        F.raise_error(message).cast(counted.schema["__row"].dataType)
    )
    return counted.withColumn("__row", checked).select(*keys, "__row.*")


def not_among(df: DataFrame, present: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose key is not in the other table."""
    known = present.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(on.values())]).distinct()
    match = [df[k] == known[f"__k{i}"] for i, k in enumerate(on)]
    return df.join(known, match, "left_anti")


def is_among(df: DataFrame, members: DataFrame, column: str, out: str) -> DataFrame:
    """A flag: the column's value occurs in the one-column table. Null is in no set."""
    known = members.toDF("__member").filter(F.col("__member").isNotNull()).distinct()
    known = known.withColumn("__in", F.lit(True))
    return (
        df.join(known, df[column] == known["__member"], "left")
        .withColumn(out, F.coalesce("__in", F.lit(False)))
        .drop("__member", "__in")
    )


def every_pair(left: DataFrame, right: DataFrame, spread: int | None = None) -> DataFrame:
    """Each row of one dimension with each row of another.

    The result is wanted whole (a spine), so its size is given; what this avoids
    is one side being shipped to every task.  The right side is cut into
    ``spread`` parts (by default as many as a shuffle has), the left side is
    repeated once per part, and the two meet in an equi-join on the part.
    """
    spread = spread or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = left.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    cut = right.withColumn("__part", F.pmod(F.xxhash64(*right.columns), F.lit(spread)).cast("int"))
    return parts.join(cut, "__part").drop("__part")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def any_of(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out


def all_of(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out
