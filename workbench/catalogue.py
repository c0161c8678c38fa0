"""All indicator definitions over survey-shaped views of the given tables.

A view gives a table the columns of a survey by formulas, nulls included.  The
formulas are SQL that both engines read; list columns come from text that is
split on ``|``.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldmark.operators.spec import compute
from fieldmark.plans import fixed_values as fixed
from fieldmark.plans.catalogue import DEFINITIONS, SURVEYS
from fieldmark.plans.indicators import Projects, combine_indicators, history_facts, join_metadata
from fieldmark.schema import FACT, fixed_table, union_aligned

from .registry import query, table

PROJECT = "new"


def yes(key: str, never: int, no: int) -> str:
    """Oui, with every ``no``-th Non and every ``never``-th missing."""
    return f"CASE WHEN {key} % {never} = 0 THEN NULL WHEN {key} % {no} = 0 THEN 'Non' ELSE 'Oui' END"


def number(key: str, modulus: int, never: int) -> str:
    return f"CASE WHEN {key} % {never} = 0 THEN NULL ELSE CAST({key} % {modulus} AS DOUBLE) END"


def state(key: str) -> str:
    return (
        f"CASE WHEN {key} % 5 = 0 THEN NULL WHEN {key} % 5 = 1 THEN 'Réception provisoire sans réserve' "
        f"WHEN {key} % 5 = 2 THEN 'En cours' ELSE 'Réception définitive' END"
    )


def offices(key: str) -> str:
    """Text to split: held offices, or missing."""
    return (
        f"CASE WHEN {key} % 7 = 0 THEN NULL WHEN {key} % 7 = 1 THEN 'Membre' WHEN {key} % 7 = 2 THEN 'Membre|Président (e)' "
        f"WHEN {key} % 7 = 3 THEN 'Sécrétaire (principal-e)' WHEN {key} % 7 = 4 THEN 'Trésorier (ère)|Membre' ELSE 'autre' END"
    )


def place(prefix: str, key: str, questions: tuple[str, ...]) -> dict[str, str]:
    parts = (5, 25, 50, 100, 200, 400)
    return {q: f"'{prefix}{i}-' || CAST({key} % {n} AS VARCHAR(20))" for i, (q, n) in enumerate(zip(questions, parts))}


def site(survey: str, key: str) -> dict[str, str]:
    return place(survey[:2], key, fixed.PLACE_QUESTIONS[survey])


_ORDER_DATE = "CAST(o_orderdate AS DATE)"
_SHIP_DATE = "CAST(l_shipdate AS DATE)"

#: survey -> (table, columns); a column whose formula starts with LIST is split into a list
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    fixed.COUNTRY_SURVEY: (
        "orders",
        {
            "DATE4": "o_orderpriority",
            "DATE5": "CAST(year(o_orderdate) AS INT)",
            "DATE11": number("o_orderkey", 101, 3),
            "IR-2": number("o_custkey", 1001, 5),
            "IR-4": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END",
            "IRI-1": number("o_orderkey", 97, 4),
            "IRI-9": number("o_custkey", 89, 6),
            "IRI-14": number("o_orderkey", 53, 7),
            "IRI-14-1": number("o_custkey", 31, 3),
            "IRI-15": yes("o_orderkey", 9, 4),
            "IRI-18": number("o_orderkey", 500, 11),
            "IRI-18-1": number("o_custkey", 50, 13),
        },
    ),
    fixed.REGIONAL_SURVEY: (
        "part",
        {
            "IND5": "2000 + p_size",
            **{f"Reg-Int-{n}": number("p_partkey", 10 + n, 1 + n) for n in (1, 2, 4, 5, 6)},
        },
    ),
    "gestion_durable_des_paysages": (
        "lineitem",
        {
            **site("gestion_durable_des_paysages", "l_suppkey"),
            "DATE": _SHIP_DATE,
            "CRDURA6c": "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END",
            "CRDURA7": yes("l_orderkey", 11, 5),
            "CRDURA8": yes("l_partkey", 13, 6),
            "CRDURA9": "CASE WHEN l_returnflag = 'A' THEN '' WHEN l_returnflag = 'N' THEN NULL ELSE 'Non' END",
            "CRDURA11": yes("l_orderkey", 7, 3),
            "CRDURA12": f"CASE WHEN l_linenumber = 2 THEN NULL ELSE {_SHIP_DATE} END",
            "CRDURA13": "CAST(l_partkey % 20 AS INT)",
            "CRDURA14": "CAST(l_suppkey % 5 AS INT)",
            "CRDURA17": "LIST " + offices("l_orderkey"),
            "CRDURA24": yes("l_suppkey", 6, 4),
            "CRDURA26c": "l_quantity * 2",
            "CRDURA41": yes("l_partkey", 5, 2),
            "CRDURA43c": "CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE l_quantity * 3 END",
            # CRDURA56 and 58c are questions this survey does not have
        },
    ),
    "unites_veterinaires": (
        "customer",
        {
            **site("unites_veterinaires", "c_custkey"),
            "DATE": "DATE '2023-05-01'",
            "STUV5": state("c_custkey"),
            "CFUV1": yes("c_custkey", 11, 9),
            "CFUV2": yes("c_custkey", 13, 8),
            "CFUV3": yes("c_custkey", 17, 7),
            "CFUV4": yes("c_custkey", 19, 6),
        },
    ),
    "parcs_de_vaccination": (
        "orders",
        {
            **site("parcs_de_vaccination", "o_custkey"),
            "DATE": _ORDER_DATE,
            "STVAC5": state("o_orderkey"),
            "IGVAC1": yes("o_orderkey", 11, 3),
            "IGVAC2": yes("o_custkey", 7, 4),
            "IGVAC9": yes("o_custkey", 5, 3),
            "IGVAC11": "CAST(o_orderkey % 40 AS INT)",
            "IGVAC12": "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey % 8 AS INT) END",
            "IGVAC12A": "LIST " + offices("o_orderkey"),
        },
    ),
    "points_d_eau": (
        "part",
        {
            **site("points_d_eau", "p_partkey"),
            "DATE": "DATE '2024-02-29'",
            "STPE5": state("p_partkey"),
            "LPE6": yes("p_partkey", 7, 3),
            "CFPE2": yes("p_partkey", 11, 4),
            "CFPE4": yes("p_size", 9, 7),
            "CFPE6": yes("p_size", 13, 8),
            "IGPE6": yes("p_partkey", 4, 3),
            "IGPE10": "p_size",
            "IGPE11": "CAST(p_partkey % 9 AS INT)",
            "IGPE11A3": "LIST " + offices("p_partkey"),
        },
    ),
    # this survey lacks the list of offices (IGMBA): it says nothing on IRI-16
    "marches_a_betail": (
        "events",
        {
            **site("marches_a_betail", "user_id"),
            "DATE": "CAST(ts AS DATE)",
            "STMB5": state("event_id"),
            "CMOP1": yes("event_id", 8, 7),
            "CMOP3": yes("event_id", 9, 11),
            "CMOP4": yes("user_id", 10, 7),
            "CMOP6": yes("user_id", 11, 13),
            "IGMB5": yes("event_id", 4, 3),
        },
    ),
    "sous_projets_innovants": (
        "lineitem",
        {
            **site("sous_projets_innovants", "l_suppkey"),
            "DATE": _SHIP_DATE,
            **{f"VAINO{i}": number(key, 17 + i, 1 + i % 7 + i // 7) for i, key in zip(
                range(6, 19), ["l_orderkey", "l_partkey", "l_suppkey"] * 5)},
        },
    ),
    "activites_generatrices_de_revenus": (
        "events",
        {
            **site("activites_generatrices_de_revenus", "event_id"),
            "DATE": "CAST(ts AS DATE)",
            "VAAGR6": number("event_id", 41, 5),
            "VAAGR7": number("event_id", 23, 6),
            "VAAGR7A": number("user_id", 12, 4),
            "VAAGR8": number("event_id", 7, 3),
            "VAAGR9": number("user_id", 9, 2),
            "VAAGR10": number("user_id", 6, 5),
            "VAAGR11": number("event_id", 8, 7),
        },
    ),
}


#: answers that the views above lack; with them, every definition has rows
MORE: dict[str, dict[str, str]] = {
    "gestion_durable_des_paysages": {
        "CRDURA56": yes("l_suppkey", 7, 3),
        "CRDURA58c": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity * 5 END",
    },
    "marches_a_betail": {
        "IGMB7": "CAST(event_id % 30 AS INT)",
        "IGMB8": "CASE WHEN user_id % 9 = 0 THEN NULL ELSE CAST(user_id % 7 AS INT) END",
        "IGMBA": "LIST " + offices("event_id"),
    },
}


def columns_of(survey: str, whole: bool = False) -> tuple[str, dict[str, str]]:
    source, columns = VIEWS[survey]
    return source, columns | (MORE.get(survey, {}) if whole else {})


def view(spark, sf, survey: str, whole: bool = False):
    source, columns = columns_of(survey, whole)
    made = []
    for out, formula in columns.items():
        listed = formula.startswith("LIST ")
        value = F.expr(formula.removeprefix("LIST ").replace("VARCHAR(20)", "STRING"))
        made.append((F.split(value, r"\|") if listed else value).alias(out))
    return table(spark, sf, source).select(*made)


def view_sql(survey: str, whole: bool = False) -> str:
    source, columns = columns_of(survey, whole)
    made = [
        f"string_split({f.removeprefix('LIST ')}, '|') AS \"{out}\"" if f.startswith("LIST ") else f"{f} AS \"{out}\""
        for out, f in columns.items()
    ]
    return f"(SELECT {', '.join(made)} FROM {source})"


OUT = [
    "indicator_code", "date", "level", "country", "region", "province", "commune", "localite", "coordinates",
    "numerator", "denominator", "value",
]


def facts(spark, sf, *surveys: str):
    tables = {s: view(spark, sf, s) for s in surveys}
    made = compute(tables, SURVEYS, DEFINITIONS, PROJECT)
    return union_aligned(made, FACT).select(*OUT)


# --- the definitions in SQL ------------------------------------------------------


def _place_sql(survey: str) -> str:
    if survey == fixed.COUNTRY_SURVEY:
        return "DATE5 || '-01-01' AS date, 2 AS level, DATE4 AS country" + _no_places(1)
    if survey == fixed.REGIONAL_SURVEY:
        return "IND5 || '-01-01' AS date, 1 AS level, 'Régional' AS country" + _no_places(1)
    names = ("country", "region", "province", "commune", "localite", "coordinates")
    columns = ", ".join(f'"{q}" AS {n}' for q, n in zip(fixed.PLACE_QUESTIONS[survey], names))
    return f"CAST(DATE AS VARCHAR) AS date, 6 AS level, {columns}"


def _no_places(first: int) -> str:
    names = ("country", "region", "province", "commune", "localite", "coordinates")
    return "".join(f", CAST(NULL AS VARCHAR) AS {n}" for n in names[first:])


def fact_sql(survey, code, value, where, num="NULL", den="NULL", date=None, whole=False) -> str:
    where_from = _place_sql(survey)
    if date:
        where_from = where_from.replace("CAST(DATE AS VARCHAR) AS date", f"CAST({date} AS VARCHAR) AS date")
    return (
        f"SELECT '{code}' AS indicator_code, {where_from}, CAST({num} AS DOUBLE) AS numerator, "
        f"CAST({den} AS DOUBLE) AS denominator, CAST({value} AS DOUBLE) AS value FROM {view_sql(survey, whole)} WHERE {where}"
    )


def union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


_PAYS, _REG = fixed.COUNTRY_SURVEY, fixed.REGIONAL_SURVEY
_LAND, _VENT, _INC = "gestion_durable_des_paysages", "sous_projets_innovants", "activites_generatrices_de_revenus"
_PROV = "'Réception provisoire sans réserve'"
_FINAL = "'Réception définitive'"


def _answer(code, column, divide=""):
    return fact_sql(_PAYS, code, f'"{column}"{divide}', f'"{column}" IS NOT NULL')


COUNTRY_SQL = union(
    _answer("IR-1", "DATE11", " / 100"),
    fact_sql(_PAYS, "IR-2", 'CASE WHEN "IR-2" <= 500 THEN "IR-2" * 1000000 ELSE "IR-2" END', '"IR-2" IS NOT NULL'),
    _answer("IR-4", "IR-4"),
    _answer("IRI-1", "IRI-1", " / 100"),
    _answer("IRI-9", "IRI-9", " / 100"),
    _answer("IRI-14", "IRI-14"),
    _answer("IRI-141", "IRI-14-1"),
    fact_sql(_PAYS, "IRI-15", "CASE WHEN \"IRI-15\" = 'Oui' THEN 1 ELSE 0 END", '"IRI-15" IS NOT NULL'),
    _answer("IRI-18", "IRI-18"),
    _answer("IRI-181", "IRI-18-1"),
)

REGIONAL_SQL = union(
    *[fact_sql(_REG, f"Reg Int {n}", f'"Reg-Int-{n}"', f'"Reg-Int-{n}" IS NOT NULL') for n in (1, 2, 4, 5, 6)]
)


def _office_sql(survey, committee, members, women, held, whole=False):
    flag = (
        f"CASE WHEN {members} > 0 AND {women} >= {members} * 0.15::DOUBLE AND (list_contains({held}, 'Président (e)') "
        f"OR list_contains({held}, 'Sécrétaire (principal-e)') OR list_contains({held}, 'Trésorier (ère)')) THEN 1 ELSE 0 END"
    )
    return fact_sql(survey, "IRI-16", flag, f"{committee} = 'Oui'", flag, "1", whole=whole)


_AREAS = (
    "CASE WHEN CRDURA6c <> 0 AND CRDURA7 = 'Oui' AND CRDURA8 = 'Oui' AND CRDURA11 = 'Oui' AND CRDURA9 <> '' THEN CRDURA6c ELSE 0 END"
    " + CASE WHEN CRDURA26c <> 0 AND CRDURA24 = 'Oui' THEN CRDURA26c ELSE 0 END"
    " + CASE WHEN CRDURA43c <> 0 AND CRDURA41 = 'Oui' THEN CRDURA43c ELSE 0 END"
)
_FOURTH_AREA = " + CASE WHEN CRDURA58c <> 0 AND CRDURA56 = 'Oui' THEN CRDURA58c ELSE 0 END"

LAND_SQL = union(
    fact_sql(_LAND, "IR-3", _AREAS, "true"),
    fact_sql(_LAND, "IRI-5", "1", "CRDURA11 = 'Oui'", date="CRDURA12"),
    _office_sql(_LAND, "CRDURA11", "CRDURA13", "CRDURA14", "CRDURA17"),
)


def _site_sql(code, survey, column, *conditions):
    final = " AND ".join(f"{c} = 'Oui'" for c in conditions)
    return fact_sql(survey, code, "1", f"{column} = {_PROV} OR ({column} = {_FINAL} AND {final})")


SITES_SQL = union(
    _site_sql("IRI-2", "unites_veterinaires", "STUV5", "CFUV1", "CFUV2", "CFUV3", "CFUV4"),
    _site_sql("IRI-3", "parcs_de_vaccination", "STVAC5", "IGVAC1", "IGVAC2"),
    _site_sql("IRI-6", "points_d_eau", "STPE5", "LPE6", "CFPE2", "CFPE4", "CFPE6"),
    _site_sql("IRI-8", "marches_a_betail", "STMB5", "CMOP1", "CMOP3", "CMOP4", "CMOP6"),
    _office_sql("parcs_de_vaccination", "IGVAC9", "IGVAC11", "IGVAC12", "IGVAC12A"),
    _office_sql("points_d_eau", "IGPE6", "IGPE10", "IGPE11", "IGPE11A3"),
)


def _total_sql(code, survey, expression):
    return fact_sql(survey, code, expression, f"{expression} > 0")


def _z(column):
    return f"coalesce({column}, 0)"


def _share_sql(survey, women, part):
    count = _z(part)
    return fact_sql(survey, "IRI-17", f"round({count} / {women}, 3)", f"{women} > 0 AND {count} <= {women}", count, women)


VENTURES_SQL = union(
    _total_sql("IRI-10", _VENT, f"{_z('VAINO6')} + {_z('VAINO13')}"),
    _total_sql("IRI-101", _VENT, f"{_z('VAINO9')} + {_z('VAINO11')} + VAINO15 + VAINO17"),
    _total_sql("IRI-102", _VENT, f"{_z('VAINO10')} + {_z('VAINO12')} + VAINO16 + VAINO18"),
    _total_sql("IRI-103", _VENT, f"{_z('VAINO7')} + {_z('VAINO14')}"),
    _share_sql(_VENT, "VAINO7", "VAINO8"),
)

INCOME_SQL = union(
    fact_sql(_INC, "IRI-13", "VAAGR6", "VAAGR6 IS NOT NULL"),
    _total_sql("IRI-131", _INC, f"{_z('VAAGR8')} + {_z('VAAGR10')}"),
    _total_sql("IRI-132", _INC, f"{_z('VAAGR9')} + {_z('VAAGR11')}"),
    fact_sql(_INC, "IRI-133", "VAAGR6", "VAAGR7 IS NOT NULL"),
    _share_sql(_INC, "VAAGR7", "VAAGR7A"),
)


#: all nine surveys, every question answered
EVERY_SURVEY = tuple(s.key for s in SURVEYS)
EVERY_SQL = union(
    COUNTRY_SQL,
    REGIONAL_SQL,
    fact_sql(_LAND, "IR-3", _AREAS + _FOURTH_AREA, "true", whole=True),
    *LAND_SQL.split("\nUNION ALL\n")[1:],
    SITES_SQL,
    _office_sql("marches_a_betail", "IGMB5", "IGMB7", "IGMB8", "IGMBA", whole=True),
    VENTURES_SQL,
    INCOME_SQL,
)


@query("catalogue_country_survey", COUNTRY_SQL)
def catalogue_country(spark, sf):
    return facts(spark, sf, _PAYS)


@query("catalogue_regional_survey", REGIONAL_SQL)
def catalogue_regional(spark, sf):
    return facts(spark, sf, _REG)


@query("catalogue_land_management", LAND_SQL)
def catalogue_land(spark, sf):
    return facts(spark, sf, _LAND)


@query("catalogue_site_surveys", SITES_SQL)
def catalogue_sites(spark, sf):
    return facts(spark, sf, "unites_veterinaires", "parcs_de_vaccination", "points_d_eau", "marches_a_betail")


@query("catalogue_ventures", VENTURES_SQL)
def catalogue_ventures(spark, sf):
    return facts(spark, sf, _VENT)


@query("catalogue_income_activities", INCOME_SQL)
def catalogue_income(spark, sf):
    return facts(spark, sf, _INC)


# --- history, combination, metadata ------------------------------------------------

_HISTORY = {
    "Code": "CASE l_returnflag WHEN 'A' THEN 'IR-1' WHEN 'N' THEN 'IRI-2' ELSE 'Reg Int 7' END",
    "année": "CAST(year(l_shipdate) AS INT)",
    "Pays": "CASE l_linenumber WHEN 1 THEN 'BF' WHEN 2 THEN 'MR' WHEN 3 THEN 'SN' WHEN 4 THEN 'REGIONAL' WHEN 5 THEN 'NE' WHEN 6 THEN 'XX' ELSE NULL END",
    "valeur": "CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity END",
}


def history_view(spark, sf):
    return table(spark, sf, "lineitem").select(*[F.expr(f).alias(c) for c, f in _HISTORY.items()])


HISTORY_SQL = f"""
SELECT Code AS indicator_code, "année" || '-01-01' AS date, CASE WHEN Pays = 'REGIONAL' THEN 1 ELSE 2 END AS level,
       CASE Pays WHEN 'BF' THEN 'Burkina-Faso' WHEN 'MR' THEN 'Mauritanie' WHEN 'SN' THEN 'Sénégal'
                 WHEN 'REGIONAL' THEN 'Régional' WHEN 'NE' THEN 'Niger' ELSE Pays END AS country,
       'old' AS project, CASE WHEN Code IN ('IR-1', 'Reg Int 7') THEN valeur / 100 ELSE valeur END AS value
FROM (SELECT {', '.join(f'{f} AS "{c}"' for c, f in _HISTORY.items())} FROM lineitem)
"""


@query("history_values", HISTORY_SQL)
def history_values(spark, sf):
    return history_facts(history_view(spark, sf), "old").drop("src_line")


WITH_HISTORY_SQL = f"""
SELECT indicator_code, date, level, country, NULL AS region, NULL AS numerator, NULL AS denominator, value, project, 0 AS src_rank FROM ({HISTORY_SQL})
UNION ALL BY NAME
SELECT indicator_code, date, level, country, region, numerator, denominator, value, 'new' AS project, 1 AS src_rank FROM ({EVERY_SQL})
"""


def every_table(spark, sf):
    """All nine surveys with all questions."""
    return {s: view(spark, sf, s, whole=True) for s in EVERY_SURVEY}


@query("facts_with_history", WITH_HISTORY_SQL)
def facts_with_history(spark, sf):
    """Facts of all nine surveys after the history; every definition has rows."""
    combined = combine_indicators(every_table(spark, sf), history_facts(history_view(spark, sf), "old"), Projects("old", "new"))
    return combined.select("indicator_code", "date", "level", "country", "region", "numerator", "denominator", "value", "project", "src_rank")


#: code, new code, name, unit, note
_META = (
    ("A", "A2", "Animaux vaccinés", "count", "NOUVEAU CODE D'INDICATEUR"),
    ("N", "N2", "Part des animaux", "percent", "Indicateur SUPPRIMÉ en 2025"),
    ("X", "X2", "Sans données", "count", None),
)


def _quoted(value):
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_META_VALUES = ", ".join("(" + ", ".join(_quoted(v) for v in row) + ")" for row in _META)


@query(
    "metadata_left_join",
    f"""WITH meta(code_old, code_new, designation, unit, note) AS (VALUES {_META_VALUES})
    SELECT code_new AS indicator_code, designation AS indicator_name, unit, CAST(year(l_shipdate) AS INTEGER) AS date,
           l_quantity AS value, coalesce(note ILIKE '%indicateur supprimé%', false) AS indicator_changed
    FROM lineitem LEFT JOIN meta ON l_returnflag = code_old""",
)
def metadata_left_join(spark, sf):
    meta = fixed_table(
        spark, _META, "code_old string, code_new string, designation string, unit string, note string"
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("indicator_code"),
        F.to_date("l_shipdate").cast("string").alias("date"),
        F.col("l_quantity").alias("value"),
    )
    joined = join_metadata(lines, meta)
    return joined.select("indicator_code", "indicator_name", "unit", "date", "value", "indicator_changed")


# --- union of unlike tables ----------------------------------------------------------

_UNLIKE = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("flag", T.StringType()),
    ]
)


@query(
    "union_diagonal",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, CAST(o_custkey AS DOUBLE) AS value, 2 AS level,
              o_orderpriority AS country, CAST(NULL AS VARCHAR) AS flag FROM orders
       UNION ALL SELECT event_type, CASE WHEN user_id % 2 = 0 THEN 1.0 ELSE 0.0 END, NULL, NULL, CAST(event_id AS VARCHAR) FROM events
       UNION ALL SELECT CAST(n_nationkey AS VARCHAR), NULL, CAST(n_regionkey AS INTEGER), n_name, NULL FROM nation""",
)
def union_diagonal(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").alias("value"),
        F.lit(2).cast("long").alias("level"),
        F.col("o_orderpriority").alias("country"),
    )
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("date"),
        (F.col("user_id") % 2 == 0).alias("value"),
        F.col("event_id").alias("flag"),
    )
    nations = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("date"), F.col("n_regionkey").alias("level"), F.col("n_name").alias("country")
    )
    return union_aligned([orders, events, nations], _UNLIKE)
