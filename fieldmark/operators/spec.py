"""Indicators as data: what to keep of a survey and what to make of it.

All indicators of one survey come out of a single pass over it: each row builds
an array with one entry per indicator it counts for, and the array is exploded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FACT, PLACE_COLUMNS, align, col_or_null, name
from .lookups import all_of


class Fields:
    """Columns of a survey by name; ``optional`` ones are null where absent."""

    def __init__(self, df: DataFrame):
        self._df = df

    def __getitem__(self, column: str) -> Column:
        return name(column)

    def optional(self, column: str) -> Column:
        return col_or_null(self._df, column)

    def kind(self, column: str) -> T.DataType | None:
        return self._df.schema[column].dataType if column in self._df.columns else None


Expr = Callable[[Fields], Column]


@dataclass(frozen=True)
class Indicator:
    """One definition.

    ``needs`` names the columns without which the survey says nothing about this
    indicator: it then yields no rows.  ``keep`` is three-valued, null drops the row.
    """

    code: str
    survey: str
    value: Expr
    keep: Expr | None = None
    numerator: Expr | None = None
    denominator: Expr | None = None
    date: Expr | None = None
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Survey:
    """Where a survey's rows lie: level, date and place columns."""

    key: str
    level: int
    date: Expr
    places: dict[str, Expr] = field(default_factory=dict)


#: the number of a submission, which grows as submissions come in
ROW_ID = "_id"


def _entry(spec: Indicator, survey: Survey, f: Fields) -> Column:
    none = F.lit(None).cast("double")
    entry = F.struct(
        F.lit(spec.code).alias("indicator_code"),
        (spec.date or survey.date)(f).cast("string").alias("date"),
        (spec.numerator(f).cast("double") if spec.numerator else none).alias("numerator"),
        (spec.denominator(f).cast("double") if spec.denominator else none).alias("denominator"),
        spec.value(f).cast("double").alias("value"),
    )
    return F.when(spec.keep(f), entry) if spec.keep else entry


def _place(df: DataFrame, column: Column, out: str) -> Column:
    kind = df.select(column).schema.fields[0].dataType
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return (F.to_json(column) if nested else column.cast("string")).alias(out)


def survey_facts(df: DataFrame, survey: Survey, specs: Sequence[Indicator], project: str, rank: int = 1) -> DataFrame:
    """All facts one survey yields, in the fact schema."""
    f = Fields(df)
    present = [s for s in specs if all(c in df.columns for c in s.needs)]
    if not present:
        return align(df.sparkSession.createDataFrame([], FACT), FACT)
    places = [
        _place(df, survey.places[p](f), p) if p in survey.places else F.lit(None).cast("string").alias(p)
        for p in PLACE_COLUMNS
    ]
    line = F.col(ROW_ID).try_cast("long") if ROW_ID in df.columns else F.lit(None).cast("long")
    facts = df.select(*places, line.alias("__line"), F.explode(F.array(*[_entry(s, survey, f) for s in present])).alias("e"))
    facts = facts.filter(F.col("e").isNotNull()).select("e.*", "__line", *PLACE_COLUMNS)
    facts = facts.withColumns(
        {"level": F.lit(survey.level), "project": F.lit(project), "src_rank": F.lit(rank), "src_line": F.col("__line")}
    )
    return align(facts, FACT)


def compute(
    tables: dict[str, DataFrame],
    surveys: Iterable[Survey],
    specs: Sequence[Indicator],
    project: str,
) -> list[DataFrame]:
    """One fact table per survey that is there."""
    return [
        survey_facts(tables[s.key], s, [i for i in specs if i.survey == s.key], project)
        for s in surveys
        if s.key in tables and any(i.survey == s.key for i in specs)
    ]


def equal(**wanted: str) -> Expr:
    """All named columns hold the given values."""
    return lambda f: all_of([f[c] == v for c, v in wanted.items()])
