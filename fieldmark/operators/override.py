"""Official figures in place of computed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SOURCED_VALUE, align
from .lookups import is_among, not_among

COMPUTED = "survey"
OFFICIAL = "official"

_KEYS = ("indicator_code", "date", "country")


def override(computed: DataFrame, official: DataFrame, match: str = "independent") -> DataFrame:
    """Computed rows that the official table does not replace, and all official rows.

    ``independent``: a computed row goes if its code is among the official
    codes, its year among the official years and its country among the official
    countries, each on its own.  ``tuple``: only if the three occur together.
    A row with a null among the three stays.
    """
    base = align(computed.withColumn("data_source", F.lit(COMPUTED)), SOURCED_VALUE)
    figures = align(official.withColumn("data_source", F.lit(OFFICIAL)), SOURCED_VALUE)
    if match == "tuple":
        kept = not_among(base, figures, {k: k for k in _KEYS})
    else:
        kept = base
        for key in _KEYS:
            kept = is_among(kept, figures.select(key), key, f"__{key}")
        flags = [f"__{key}" for key in _KEYS]
        kept = kept.filter(~(F.col(flags[0]) & F.col(flags[1]) & F.col(flags[2]))).drop(*flags)
    return kept.unionByName(figures)
