"""The 31 indicator definitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import zero_if_null
from ..functions.text import january_first
from ..operators.lookups import all_of, any_of
from ..operators.spec import Expr, Fields, Indicator, Survey, equal
from . import fixed_values as fixed

_PLACES = ("country", "region", "province", "commune", "localite", "coordinates")


def _column(question: str) -> Expr:
    return lambda f: f[question]


def _site_survey(key: str) -> Survey:
    places = {place: _column(q) for place, q in zip(_PLACES, fixed.PLACE_QUESTIONS[key])}
    return Survey(key, 6, _column("DATE"), places)


SURVEYS = (
    Survey(fixed.REGIONAL_SURVEY, 1, lambda f: january_first(f["IND5"]), {"country": lambda f: F.lit(fixed.TOP_PLACE)}),
    Survey(fixed.COUNTRY_SURVEY, 2, lambda f: january_first(f["DATE5"]), {"country": _column("DATE4")}),
    _site_survey("gestion_durable_des_paysages"),
    _site_survey("unites_veterinaires"),
    _site_survey("parcs_de_vaccination"),
    _site_survey("points_d_eau"),
    _site_survey("marches_a_betail"),
    _site_survey("sous_projets_innovants"),
    _site_survey("activites_generatrices_de_revenus"),
)


# --- forms the definitions share -------------------------------------------


def _reported(code: str, question: str, survey: str = fixed.COUNTRY_SURVEY, share: bool = False, **more) -> Indicator:
    """The answer itself, where there is one; a percentage as a share."""
    value = (lambda f: f[question] / 100) if share else _column(question)
    return Indicator(code, survey, value, keep=lambda f: f[question].isNotNull(), **more)


def _one(f: Fields) -> Column:
    return F.lit(1)


def _working_site(code: str, survey: str, *conditions: str) -> Indicator:
    """1 for a site received provisionally without reserve, or finally and meeting all conditions."""

    def keep(f: Fields) -> Column:
        state = f[fixed.STATE_QUESTION[survey]]
        final = all_of([state == fixed.STATE_FINAL, *[f[c] == fixed.YES for c in conditions]])
        return (state == fixed.STATE_PROVISIONAL) | final

    return Indicator(code, survey, _one, keep=keep)


def _positive_total(code: str, survey: str, filled: tuple[str, ...], bare: tuple[str, ...] = ()) -> Indicator:
    """A sum of answers where it is positive.

    Nulls among ``filled`` count as zero; one among ``bare`` makes the sum null.
    """

    def total(f: Fields) -> Column:
        terms = [zero_if_null(f[q]) for q in filled] + [f[q] for q in bare]
        out = terms[0]
        for term in terms[1:]:
            out = out + term
        return out

    return Indicator(code, survey, total, keep=lambda f: total(f) > 0)


def _women_in_office(survey: str, committee: str, members: str, women: str, offices: str) -> Indicator:
    """Of the places with a committee, those where women have their share and hold an office."""

    def fair(f: Fields) -> Column:
        held = any_of([F.array_contains(f[offices], office) for office in fixed.OFFICES])
        met = (f[members] > 0) & (f[women] >= f[members] * fixed.WOMEN_SHARE) & held
        return F.when(met, 1).otherwise(0)

    return Indicator(
        "IRI-16", survey, fair, keep=equal(**{committee: fixed.YES}), numerator=fair, denominator=_one, needs=(offices,)
    )


def _women_share(survey: str, women: str, part: str) -> Indicator:
    """A part of the women as a share of them, where it is not more than all."""

    def count(f: Fields) -> Column:
        return zero_if_null(f[part])

    return Indicator(
        "IRI-17",
        survey,
        value=lambda f: F.round(F.try_divide(count(f).cast("double"), f[women].cast("double")), 3),
        keep=lambda f: (f[women] > 0) & (count(f) <= f[women]),
        numerator=count,
        denominator=_column(women),
    )


def _truthy(f: Fields, question: str) -> Column:
    """An answer that is there and neither empty nor zero."""
    answer, kind = f.optional(question), f.kind(question)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        there = F.size(answer) > 0
    elif isinstance(kind, T.NumericType):
        there = answer != 0
    elif isinstance(kind, T.StringType):
        there = answer != ""
    elif isinstance(kind, T.BooleanType):
        there = answer
    else:
        there = answer.isNotNull()
    return F.coalesce(there, F.lit(False))


def _managed_area(fourth_condition: Expr) -> Expr:
    """Area of four kinds of works, each counted only where its conditions hold."""

    def yes(f: Fields, question: str) -> Column:
        return F.coalesce(f.optional(question) == fixed.YES, F.lit(False))

    def total(f: Fields) -> Column:
        works = (
            ("CRDURA6c", all_of([yes(f, "CRDURA7"), yes(f, "CRDURA8"), yes(f, "CRDURA11"), fourth_condition(f)])),
            ("CRDURA26c", yes(f, "CRDURA24")),
            ("CRDURA43c", yes(f, "CRDURA41")),
            ("CRDURA58c", yes(f, "CRDURA56")),
        )
        out = F.lit(0.0)
        for area, condition in works:
            counted = _truthy(f, area) & condition
            out = out + F.when(counted, f.optional(area).cast("double")).otherwise(0.0)
        return out

    return total


# --- the definitions --------------------------------------------------------

_PAYS = fixed.COUNTRY_SURVEY
_LAND = "gestion_durable_des_paysages"
_VENTURES = "sous_projets_innovants"
_INCOME = "activites_generatrices_de_revenus"

# Up to this, an answer to IR-2 is in millions.
IR_2_MILLIONS_UP_TO = 500

DEFINITIONS: tuple[Indicator, ...] = (
    _reported("IR-1", "DATE11", share=True),
    Indicator(
        "IR-2",
        _PAYS,
        lambda f: F.when(f["IR-2"] <= IR_2_MILLIONS_UP_TO, f["IR-2"] * 1_000_000).otherwise(f["IR-2"]),
        keep=lambda f: f["IR-2"].isNotNull(),
    ),
    Indicator("IR-3", _LAND, _managed_area(lambda f: _truthy(f, "CRDURA9"))),
    _reported("IR-4", "IR-4"),
    _reported("IRI-1", "IRI-1", share=True),
    _working_site("IRI-2", "unites_veterinaires", "CFUV1", "CFUV2", "CFUV3", "CFUV4"),
    _working_site("IRI-3", "parcs_de_vaccination", "IGVAC1", "IGVAC2"),
    Indicator("IRI-5", _LAND, _one, keep=equal(CRDURA11=fixed.YES), date=_column("CRDURA12")),
    _working_site("IRI-6", "points_d_eau", "LPE6", "CFPE2", "CFPE4", "CFPE6"),
    _working_site("IRI-8", "marches_a_betail", "CMOP1", "CMOP3", "CMOP4", "CMOP6"),
    _reported("IRI-9", "IRI-9", share=True),
    _positive_total("IRI-10", _VENTURES, ("VAINO6", "VAINO13")),
    _positive_total("IRI-101", _VENTURES, ("VAINO9", "VAINO11"), ("VAINO15", "VAINO17")),
    _positive_total("IRI-102", _VENTURES, ("VAINO10", "VAINO12"), ("VAINO16", "VAINO18")),
    _positive_total("IRI-103", _VENTURES, ("VAINO7", "VAINO14")),
    _reported("IRI-13", "VAAGR6", _INCOME),
    _positive_total("IRI-131", _INCOME, ("VAAGR8", "VAAGR10")),
    _positive_total("IRI-132", _INCOME, ("VAAGR9", "VAAGR11")),
    # women: kept by their own answer, valued by the total
    Indicator("IRI-133", _INCOME, _column("VAAGR6"), keep=lambda f: f["VAAGR7"].isNotNull()),
    _reported("IRI-14", "IRI-14"),
    _reported("IRI-141", "IRI-14-1"),
    Indicator("IRI-15", _PAYS, lambda f: f["IRI-15"] == fixed.YES, keep=lambda f: f["IRI-15"].isNotNull()),
    _women_in_office("parcs_de_vaccination", "IGVAC9", "IGVAC11", "IGVAC12", "IGVAC12A"),
    _women_in_office(_LAND, "CRDURA11", "CRDURA13", "CRDURA14", "CRDURA17"),
    _women_in_office("points_d_eau", "IGPE6", "IGPE10", "IGPE11", "IGPE11A3"),
    _women_in_office("marches_a_betail", "IGMB5", "IGMB7", "IGMB8", "IGMBA"),
    _women_share(_VENTURES, "VAINO7", "VAINO8"),
    _women_share(_INCOME, "VAAGR7", "VAAGR7A"),
    _reported("IRI-18", "IRI-18"),
    _reported("IRI-181", "IRI-18-1"),
    *[
        _reported(f"Reg Int {n}", f"Reg-Int-{n}", fixed.REGIONAL_SURVEY, needs=(f"Reg-Int-{n}",))
        for n in (1, 2, 4, 5, 6)
    ],
)

#: variants of definitions that look unintended, for use in place of the above
VARIANTS: tuple[Indicator, ...] = (
    Indicator("IR-3", _LAND, _managed_area(lambda f: F.coalesce(f.optional("CRDURA9") == fixed.YES, F.lit(False)))),
    _positive_total("IRI-101", _VENTURES, ("VAINO9", "VAINO11", "VAINO15", "VAINO17")),
    _positive_total("IRI-102", _VENTURES, ("VAINO10", "VAINO12", "VAINO16", "VAINO18")),
    _reported("IRI-133", "VAAGR7", _INCOME),
)


def definitions(variants: tuple[str, ...] = ()) -> tuple[Indicator, ...]:
    """The definitions, with the named codes in their variant."""
    swapped = {v.code: v for v in VARIANTS if v.code in variants}
    return tuple(swapped.get(d.code, d) for d in DEFINITIONS)
