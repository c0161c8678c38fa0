"""One row per key, chosen by an explicit rule.

The choice is an aggregation, not a numbered window: it combines within each task
before the shuffle, so a key with any number of copies reaches the final task as a
few candidates.  What is aggregated are keys, ranks and the *place* of a row, columns
that tell it from all others: its id, or its place in the files it is read from
(``with_places``).  The winners then take their rows, however wide, by one semi-join.
Without a place the rows themselves are aggregated, which sorts them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: columns that ``with_places`` adds
PLACE = ["__file", "__line"]


def with_places(df: DataFrame) -> DataFrame:
    """Adds the place of each row in the Parquet files it is read from; ``df`` is the table as read, or its columns or rows picked."""
    return df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__line"))


def _picked(df: DataFrame, keys: Sequence[str], choice: Callable[..., Column], rank: Column, place: Sequence[str]) -> DataFrame:
    """The row of each key of which ``choice`` (min_by, max_by) takes the rank."""
    if place:
        # equal ranks go by the place, so the choice is the same in every run
        at = F.struct(*place)
        narrow = df.select(*keys, rank.alias("__rank"), at.alias("__at"))
        won = narrow.groupBy(*keys).agg(choice("__at", F.struct("__rank", "__at")).alias("__won"))
        won = won.select(*[F.col(f"__won.{p}").alias(f"__won_{p}") for p in place])
        return df.join(won.hint("shuffle_hash"), [F.col(p) == F.col(f"__won_{p}") for p in place], "left_semi")
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(choice(F.struct(*rest), rank).alias("__row"))
    return chosen.select(*keys, "__row.*").select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], priority: Sequence[Column], place: Sequence[str] = ()) -> DataFrame:
    """The row of each key that comes first by ``priority``; nulls come first.

    ``place``: columns that tell a row from all others and are never null.
    """
    rank = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)])
    return _picked(df, keys, F.min_by, rank, place)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    tiebreak: Sequence[str] = (),
    nulls: str = "first",
    place: Sequence[str] = (),
) -> DataFrame:
    """The row of each key with the latest date.

    A row without a date counts as the latest with ``nulls="first"`` and as the
    earliest with ``nulls="last"``.  Equal dates go by the larger tiebreak.
    ``place``: columns that tell a row from all others and are never null.
    """
    undated = F.col(date).isNull() if nulls == "first" else F.col(date).isNotNull()
    rank = F.struct(undated.alias("u"), F.col(date).alias("d"), *tiebreak)
    return _picked(df, keys, F.max_by, rank, place)


def yearly_changes(df: DataFrame, key: str, date: str, tiebreak: Sequence[str] = (), place: Sequence[str] = ()) -> DataFrame:
    """Snapshots as intervals: the latest row of each key and year, with the years it holds for.

    ``valid_from`` is its year, ``valid_to`` the year before the key's next such row, or
    null while there is none.  However many years pass, a key has one row for each
    year in which it changed.  Rows without a date are in no snapshot.
    """
    dated = df.filter(F.col(date).isNotNull()).withColumn("valid_from", F.year(date))
    newest = latest_per_key(dated, [key, "valid_from"], date, tiebreak, place=place)
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return newest.withColumn("valid_to", following - 1)


def snapshot_of(changes: DataFrame, year: int) -> DataFrame:
    """The rows that hold in a year; the filter reaches the scan of a stored table."""
    holds = (F.col("valid_from") <= year) & (F.col("valid_to").isNull() | (F.col("valid_to") >= year))
    return changes.filter(holds)


def snapshots_of(changes: DataFrame, out: str = "over_year") -> DataFrame:
    """Every year's snapshot, up to the last year in which anything changed: years are laid out here, not in the table."""
    last_year = changes.agg(F.max("valid_from")).scalar()
    until = F.coalesce("valid_to", last_year)
    return changes.withColumn("__until", until).withColumn(
        out, F.explode(F.sequence(F.col("valid_from"), F.col("__until")))
    ).drop("__until", "valid_from", "valid_to")


def yearly_snapshots(
    df: DataFrame, key: str, date: str, tiebreak: Sequence[str] = (), out: str = "over_year", place: Sequence[str] = ()
) -> DataFrame:
    """For every year of the table, the latest row of each key up to that year.

    Only the latest row per key and year is kept (an aggregation); it then holds
    until the key's next such year, and is repeated for the years in between.
    Rows without a date are in no snapshot.
    """
    return snapshots_of(yearly_changes(df, key, date, tiebreak, place), out)


def keep_lone_or_marked(df: DataFrame, keys: Sequence[str], marked: Column) -> DataFrame:
    """Rows alone under their key, and marked rows whatever their key holds.

    Marked rows pass as they are.  Of the others those survive whose key has one
    row in all: keys are counted by hash, and the rows of a lone key come by
    one semi-join, so rows are neither gathered nor sorted.  Null keys form one group.
    """
    flagged = df.withColumns({"__marked": F.coalesce(marked, F.lit(False)), "__key": F.struct(*keys)})
    lone = flagged.groupBy(*keys).count().filter("count = 1").select(F.struct(*keys).alias("__lone"))
    others = flagged.filter(~F.col("__marked")).join(lone.hint("shuffle_hash"), F.col("__key") == F.col("__lone"), "left_semi")
    return flagged.filter("__marked").unionByName(others).drop("__marked", "__key")
