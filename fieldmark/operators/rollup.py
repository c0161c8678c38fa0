"""Values of places summed up to the places that contain them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exact import joined, part_names, part_sums
from ..functions.numeric import ieee_div
from ..schema import VALUE, align
from ..session import settle
from .dedup import keep_first

# Units whose values add up, and the other two that can be rolled up.
SUM_UNITS = ("count", "weight", "surface")
RATIO_UNIT = "percent"
FLAG_UNIT = "boolean"

# Fixed value: the place at the top.
TOP_PLACE = "Régional"

#: how a group of values becomes one, in the order used when two results compete
KINDS = ("sum", "ratio", "mean", "all")

_RANKED = T.StructType(
    VALUE.fields
    + [T.StructField(c, T.IntegerType(), True) for c in ("stage", "rank", "kind_rank")]
    + [T.StructField("line", T.LongType(), True)]
)

_ATTRIBUTES = ("indicator_code", "indicator_name", "unit", "date", "project", "indicator_changed")


@dataclass(frozen=True)
class Step:
    """Rows of one level become rows of the level above; ``places`` stay as keys."""

    source: int
    target: int
    places: tuple[str, ...]


STEPS = (Step(6, 3, ("country", "region")), Step(3, 2, ("country",)), Step(2, 1, ()))


def aggregation_kind(unit: str = "unit") -> Column:
    """Which of ``KINDS`` a row takes part in; null for units that are not rolled up."""
    with_terms = F.col("numerator").isNotNull() & F.col("denominator").isNotNull()
    return (
        F.when(F.col(unit).isin(*SUM_UNITS), "sum")
        .when((F.col(unit) == RATIO_UNIT) & with_terms, "ratio")
        .when(F.col(unit) == RATIO_UNIT, "mean")
        .when(F.col(unit) == FLAG_UNIT, "all")
    )


def _terms(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row's kind, its value, and the numbers that its kind adds up."""
    taken = df.select(
        *keys,
        aggregation_kind().alias("kind"),
        F.expr("cast(value as double) as value"),
        F.expr("cast(numerator as double) as numerator"),
        F.expr("cast(denominator as double) as denominator"),
    )
    return taken.select(
        "*",
        F.expr("case when kind = 'ratio' then numerator when kind in ('sum', 'mean') then value end as first"),
        F.expr("case when kind = 'ratio' then denominator end as second"),
    )


_PARTS = (*part_names("first"), *part_names("second"), "__n", "__all")


def _summed(terms: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Rows of a key and kind as ``_PARTS``, which can be added to those of other rows."""
    return terms.groupBy(*keys, "kind").agg(
        *part_sums(["first", "second"]),
        F.count("value").alias("__n"),
        F.bool_and(F.col("value").cast("boolean")).alias("__all"),
        *more,
    )


def _added(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_PARTS`` of finer keys as those of ``keys``."""
    sums = [F.sum(p).alias(p) for p in _PARTS if p != "__all"]
    return parts.groupBy(*keys, "kind").agg(*sums, F.bool_and("__all").alias("__all"))


def _finished(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The value, numerator and denominator that ``_PARTS`` stand for."""
    kind = F.col("kind")
    grouped = parts.select(*keys, "kind", "__n", "__all", joined("first").alias("first"), joined("second").alias("second"))
    first, second = F.coalesce("first", F.lit(0.0)), F.coalesce("second", F.lit(0.0))
    return grouped.select(
        *keys,
        "kind",
        F.when(kind == "ratio", first).alias("numerator"),
        F.when(kind == "ratio", second).alias("denominator"),
        F.when(kind == "sum", first)
        .when(kind == "ratio", ieee_div(first, second))
        .when(kind == "mean", F.try_divide("first", "__n"))
        # 1 where no value is zero, else 0; nulls do not speak against it
        .otherwise(F.coalesce("__all", F.lit(True)).cast("double"))
        .alias("value"),
    )


def aggregate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One pass over the rows for all kinds of units.

    Adds up ``value``, or numerators and denominators with their quotient, or
    takes the mean, or the logical and, whichever the row's kind asks for.  No values
    at all make a sum of zero.  Sums are exact before they are rounded once, so
    fractions give the same bits in any order.
    """
    return _finished(_summed(_terms(df, keys).filter("kind is not null"), keys), keys)


def _ranked(df: DataFrame, stage: int, rank: Column, kind: Column, line: Column | None = None) -> DataFrame:
    """The value columns, and the place of each row among its competitors."""
    return align(
        df.withColumns({"stage": F.lit(stage), "rank": rank, "kind_rank": kind, "line": F.lit(None) if line is None else line}), _RANKED
    )


_UNIQUE = ("indicator_code", "date", "level", "country", "region")


def _first_reported(df: DataFrame) -> DataFrame:
    tie = [F.col(c) for c in ("indicator_name", "unit", "project", "value", "numerator", "denominator")]
    return keep_first(df, _UNIQUE, [F.col("stage"), F.col("rank"), F.col("line").isNull(), F.col("line"), F.col("kind_rank"), *tie])


_GROUP = (*_ATTRIBUTES, "level", "country", "region", "rank")


def _grouped(rows: DataFrame) -> DataFrame:
    """All rows of one place, year, kind and source as one: their ``_PARTS``, and what tells the first of them.

    Only numbers are aggregated, so rows are hashed and never sorted.  ``line`` is the
    first line and ``value`` the first value, nulls first; ``__terms`` says
    whether any row has a numerator or denominator.
    """
    value, terms = F.col("value"), F.col("numerator").isNotNull() | F.col("denominator").isNotNull()
    summed = _summed(
        _terms(rows, [*_GROUP, "line"]),
        _GROUP,
        F.min("line").alias("line"),
        F.min(value).alias("__least"),
        F.bool_or(value.isNull()).alias("__blank"),
        F.bool_or(terms).alias("__terms"),
    )
    return summed.withColumn("value", F.when(~F.col("__blank"), F.col("__least"))).drop("__least", "__blank")


def _first_of_groups(grouped: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows among which each group's first one is.

    Where a group has neither lines nor terms its row is what the group says.  Of
    other groups those ``rows`` come that have the first line or, without lines,
    the first value; ``rows`` are not read if there is no such group.
    """
    plain = F.col("line").isNull() & ~F.col("__terms")
    told = align(grouped.filter(plain).withColumns({"stage": F.lit(0), "kind_rank": F.lit(0)}), _RANKED)
    key = F.struct(*_GROUP, "kind", "line", F.when(F.col("line").isNull(), F.col("value")).alias("value"))
    wanted = grouped.filter(~plain).select(key.alias("__wanted"))
    keyed = rows.withColumn("kind", aggregation_kind()).withColumn("__key", key)
    return told.unionByName(keyed.join(wanted, F.col("__key") == F.col("__wanted"), "left_semi").drop("kind", "__key"))


def rollup(
    df: DataFrame,
    steps: Sequence[Step] = STEPS,
    top_place: str = TOP_PLACE,
    dedup_each_level: bool = False,
) -> DataFrame:
    """Reported values and the values rolled up from the levels below, one per place and year.

    Each step aggregates what was reported at its level together with what the
    step before produced; a reported value then wins over a rolled-up one.  A
    place both reported and rolled up therefore counts twice one level further
    up; ``dedup_each_level`` removes the second before the next step.

    Rows are first made one for each place, year, kind and source, by hash, and these are
    stored; the steps and the choice of the reported row go on with them.  ``df`` is
    read once for that, and its rows up to the top level once more if some have lines or
    terms: it need not be stored.  ``src_rank``, if there, says which of two reported
    values comes first, and ``src_line`` which of two from one source: the earlier
    submission or line.
    """
    top = max(s.target for s in steps)
    rank = F.col("src_rank") if "src_rank" in df.columns else F.lit(0)
    line = F.col("src_line") if "src_line" in df.columns else None
    read = (F.col("level") <= top) | F.col("level").isin(*[s.source for s in steps])
    rows = _ranked(df.filter(read), 0, rank, F.lit(0), line)
    grouped = settle(_grouped(rows))
    up_to_top = F.col("level") <= top
    everything = _first_of_groups(grouped.filter(up_to_top), rows.filter(up_to_top))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    for stage, step in enumerate(steps, start=1):
        keys = [*_ATTRIBUTES, *step.places]
        at_source = F.col("level") == step.source
        if dedup_each_level and step.source <= top:
            made = aggregate(_first_reported(everything.filter(at_source)), keys)
        else:
            parts = grouped.filter(at_source & F.col("kind").isNotNull()).select(*keys, "kind", *_PARTS)
            if stage > 1:
                before = _terms(made_before.filter(at_source), keys).filter("kind is not null")
                parts = parts.unionByName(_summed(before, keys))
            made = _finished(_added(parts, keys), keys)
        made = made.withColumn("level", F.lit(step.target))
        if not step.places:
            made = made.withColumn("country", F.lit(top_place))
        kind_rank = F.array_position(kinds, F.col("kind"))
        ranked = settle(_ranked(made, stage, F.lit(0), kind_rank))
        everything = everything.unionByName(ranked)
        made_before = ranked if stage == 1 else made_before.unionByName(ranked)
    return _first_reported(everything).select(*VALUE.names)
