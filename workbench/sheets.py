"""Framework sheets, the report and the picture lists, over grids derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmark.operators.fingerprint import fingerprint
from fieldmark.plans import fixed_values as fixed
from fieldmark.plans.attachments import fetch_manifest, publish_manifest
from fieldmark.plans.framework import (
    assign_codes,
    combined_targets,
    framework_tables,
    results_sheet_2025,
    results_table,
    targets_sheet_2026,
)
from fieldmark.plans.report import target_vs_result, wide_report
from fieldmark.schema import fixed_table

from .registry import query, table
from .texts import label_sql

# --- the 2025 sheet: one line per part --------------------------------------------

_FODDER = "Fourrage cultivé produit et disponible aux pasteurs et agro-pasteurs grâce au projet "

#: cells of every line; merged cells are empty below their first line
_GRID_2025 = {
    "row_idx": "p_partkey",
    "column_1": """CASE WHEN p_partkey % 4 <> 0 THEN NULL WHEN p_size = 1 THEN 'FA 2' WHEN p_size = 2 THEN 'Reg Int 3'
                   ELSE CAST(p_size % 9 AS {t}) END""",
    "column_2": f"""CASE WHEN p_partkey % 4 <> 0 THEN NULL WHEN p_size > 30 THEN 'Dont ' || p_type
                   WHEN p_size = 13 THEN '{_FODDER}' ELSE p_name END""",
    "column_4": """CASE WHEN p_partkey % 8 <> 0 THEN NULL WHEN p_size < 15 THEN 'Nombre (millions)' WHEN p_size < 25 THEN 'POURCENTAGE'
                   WHEN p_size < 35 THEN 'hectares (milliers,    valeur cumulée) ' ELSE 'nombre' END""",
    "column_5": """CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN 'BF' WHEN p_partkey % 10 = 2 THEN 'MR'
                   WHEN p_partkey % 10 = 3 THEN 'MR restruc' WHEN p_partkey % 10 = 4 THEN 'Total pays' WHEN p_partkey % 10 = 5 THEN 'REGIONAL'
                   WHEN p_partkey % 10 = 6 THEN 'NE' WHEN p_partkey % 10 = 7 THEN 'SN' WHEN p_partkey % 10 = 8 THEN NULL ELSE 'TD' END""",
    "column_7": """CASE WHEN p_size % 6 = 0 THEN NULL WHEN p_size % 6 = 1 THEN 'oui' WHEN p_size % 6 = 2 THEN '12,5' WHEN p_size % 6 = 3 THEN '107'
                   ELSE CAST(p_partkey AS {t}) END""",
    "column_8": """CASE WHEN p_size % 8 = 0 THEN NULL WHEN p_size % 8 = 1 THEN 'Non' WHEN p_size % 8 = 2 THEN 'Résultats 2025' WHEN p_size % 8 = 3 THEN '5576'
                   WHEN p_size % 8 = 4 THEN '185' ELSE CAST(p_size AS {t}) || '.5' END""",
}

_PICK_2025 = {"code": "column_1", "name": "column_2", "unit": "column_4", "country": "column_5", "t": "column_7", "r": "column_8"}

# --- the 2026-27 sheet: one line per customer ---------------------------------------

_YEARS_2026 = (2021, 2022, 2023, 2024, 2026, 2027)
_GRID_2026 = {
    "row_idx": "c_custkey",
    "column_1": "CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS {t}) END",
    "column_2": f"""CASE WHEN c_custkey % 3 <> 0 THEN NULL WHEN c_nationkey > 15 THEN 'dont ' || lower(c_mktsegment)
                   WHEN c_nationkey = 3 THEN '{_FODDER}' ELSE c_mktsegment || 's' END""",
    "column_4": "CASE WHEN c_custkey % 6 = 0 THEN CASE WHEN c_nationkey < 9 THEN 'Milliers de têtes' ELSE ' nombre  (valeur cumulée)' END END",
    "column_5": "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'BF' WHEN c_custkey % 5 = 2 THEN 'ML' ELSE 'TD' END",
    **{
        f"column_{6 + i}": f"""CASE WHEN c_custkey % {4 + i} = 0 THEN NULL WHEN c_custkey % {4 + i} = 1 THEN 'OUI' WHEN c_custkey % {4 + i} = 2 THEN '-3,25 t'
                   ELSE CAST(c_custkey AS {{t}}) || ' 000' END"""
        for i in range(6)
    },
}

#: code, new code, former name, new name, unit, note
_META = (
    ("IRI-1", "IRI-1", "Red Widgets", "BUILDING", "count", None),
    ("IRI-2", "IRI-20", "les hots plates", "Machinery", "percent", "Nouveau code d'indicateur"),
    ("IRI-3", "IRI-3", "Old anvil", "Automobiles", "surface", "INDICATEUR CHANGÉ"),
    ("IRI-11", "IRI-11", "blue rods", "pas un nom", "weight", None),
    ("IR-4", "IR-4", "Cold bolts", "Household", "boolean", "indicateur supprimé"),
    ("IRI-7", "IRI-7", "Fourrages", "Fourrage", "count", "rien"),
    ("IRI-5", "IRI-5", "Dont economy", "dont furniture", "count", None),
)
_META_NAMES = ("code", "code_v2", "designation", "designation_v2", "unite_v2", "note")


def _quoted(value):
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


META_SQL = (
    f"meta({', '.join(_META_NAMES)}) AS (VALUES "
    + ", ".join("(" + ", ".join(_quoted(v) for v in row) + ")" for row in _META)
    + ")"
)


def metadata(spark):
    return fixed_table(spark, _META, ", ".join(f"{c} string" for c in _META_NAMES))


def _grid(spark, sf, source, cells):
    return table(spark, sf, source).select(*[F.expr(f.format(t="STRING")).alias(c) for c, f in cells.items()])


def grid_2025(spark, sf):
    return _grid(spark, sf, "part", _GRID_2025)


def grid_2026(spark, sf):
    return _grid(spark, sf, "customer", _GRID_2026)


def _grid_sql(source, cells):
    return f"(SELECT {', '.join(f'{f.format(t="VARCHAR")} AS {c}' for c, f in cells.items())} FROM {source})"


def _body_sql(grid: str, picked: dict[str, str]) -> str:
    """Lines below the title with merged cells filled and their order."""
    merged = ("code", "name", "unit")
    cells = ", ".join(
        f"last_value({src} IGNORE NULLS) OVER w AS {out}" if out in merged else f"{src} AS {out}" for out, src in picked.items()
    )
    return f"""
    SELECT *, min(row_idx) OVER (PARTITION BY name, code, row_idx // 100) AS original_order FROM (
      SELECT row_idx - 4 AS row_idx, {cells} FROM {grid} WHERE row_idx >= 4
      WINDOW w AS (ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _plain_sql(cell):
    return f"""CASE lower({cell}) WHEN 'oui' THEN 1.0::DOUBLE WHEN 'non' THEN 0.0::DOUBLE ELSE TRY_CAST({cell} AS DOUBLE) END"""


ROWS_2025_SQL = f"""
body25 AS ({_body_sql(_grid_sql("part", _GRID_2025), _PICK_2025)}),
lines25 AS (SELECT * REPLACE ({_plain_sql("t")} AS t, {_plain_sql("r")} AS r) FROM body25 WHERE r IS NOT NULL AND NOT contains(r, 'Résultats')),
long25 AS (
  SELECT row_idx, 0 AS var_pos, name, code, unit, country, original_order, 'target' AS value_type, t AS value FROM lines25
  UNION ALL SELECT row_idx, 1, name, code, unit, country, original_order, 'result', r FROM lines25),
placed25 AS (SELECT * REPLACE (CASE WHEN country IS NOT NULL THEN country
    WHEN code = '6' AND value IN (185, 107) THEN 'MR' WHEN code = '7' AND value IN (5576, 3509) THEN 'MR'
    WHEN code = 'FA 2' THEN 'BF' WHEN code LIKE 'Reg Int %' THEN 'REGIONAL' ELSE 'NE' END AS country) FROM long25),
variants25 AS (
  SELECT *, replace(country, ' restruc', '') AS clean_country FROM placed25 WHERE NOT contains(country, 'Total')),
rows25 AS (
  SELECT * EXCLUDE (n, clean_country) REPLACE (clean_country AS country) FROM (
    SELECT *, count(*) OVER (PARTITION BY name, code, value_type, clean_country) AS n FROM variants25)
  WHERE n = 1 OR contains(country, 'restruc'))
"""

_PICK_2026 = {"code": "column_1", "name": "column_2", "unit": "column_4", "country": "column_5"} | {
    f"t{y}": f"column_{6 + i}" for i, y in enumerate(_YEARS_2026)
}


def _first_sql(cell):
    pointed = f"CASE WHEN instr({cell}, ',') > 0 THEN left({cell}, instr({cell}, ',') - 1) || '.' || substr({cell}, instr({cell}, ',') + 1) ELSE {cell} END"
    return (
        f"CASE lower({cell}) WHEN 'oui' THEN 1.0::DOUBLE WHEN 'non' THEN 0.0::DOUBLE "
        f"ELSE TRY_CAST(nullif(regexp_extract({pointed}, '([0-9]+\\.?[0-9]*)', 1), '') AS DOUBLE) END"
    )


ROWS_2026_SQL = f"""
body26 AS ({_body_sql(_grid_sql("customer", _GRID_2026), _PICK_2026)}),
rows26 AS ({" UNION ALL ".join(
    f"SELECT row_idx, {i} AS var_pos, name, code, unit, country, original_order, 'target' AS value_type, {_first_sql(f't{y}')} AS value, {y} AS year "
    "FROM body26 WHERE country IS NOT NULL" for i, y in enumerate(_YEARS_2026))})
"""

_ROW_OUT = (
    "row_idx, var_pos, name AS indicator_name_original, code AS indicator_code_original, unit AS unit_original, country, "
    "original_order, value_type, value"
)
_ROWS = [
    "row_idx", "var_pos", "indicator_name_original", "indicator_code_original", "unit_original", "country",
    "original_order", "value_type", "value", "year",
]


@query("sheet_2025_rows", f"WITH {ROWS_2025_SQL} SELECT {_ROW_OUT}, 2025 AS year FROM rows25")
def sheet_2025_rows(spark, sf):
    return results_sheet_2025(grid_2025(spark, sf)).select(*_ROWS)


@query("sheet_2026_rows", f"WITH {ROWS_2026_SQL} SELECT {_ROW_OUT}, year FROM rows26")
def sheet_2026_rows(spark, sf):
    return targets_sheet_2026(grid_2026(spark, sf)).select(*_ROWS)


# --- codes -----------------------------------------------------------------------


def codes_sql(rows: str, tag: str, former: bool, year: str) -> str:
    """CTEs from sheet rows to rows with code, name, unit and the changed flag."""
    name, code = ("designation", "code") if former else ("designation_v2", "code_v2")
    overrides = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in fixed.CODE_OF_NAME.items())
    recoded = (
        "CASE WHEN note ILIKE '%nouveau code d''indicateur%' THEN code_ref_new ELSE code_final END" if former else "code_final"
    )
    changed = (
        "coalesce(regexp_matches(note, '(?i)indicateur supprimé|indicateur changé'), false)" if former else "false"
    )
    return f"""
items{tag} AS (SELECT {label_sql(name)} AS clean, {code} AS ref, code_v2, designation_v2, unite_v2, note FROM meta
          WHERE NOT starts_with({label_sql(name)}, 'dont ')),
names{tag} AS (SELECT n.*, CASE n.name {overrides} ELSE ref END AS code_ref, code_v2 AS code_ref_new, note, starts_with(n.clean, 'dont ') AS sub
          FROM (SELECT DISTINCT name, code, original_order, {label_sql('name')} AS clean FROM {rows}) n LEFT JOIN items{tag} i ON n.clean = i.clean),
step{tag} AS (SELECT *, last_value(CASE WHEN NOT sub THEN code_ref END IGNORE NULLS) OVER w AS parent, lag(clean) OVER (ORDER BY original_order) AS before
          FROM names{tag} WINDOW w AS (ORDER BY original_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
count{tag} AS (SELECT *, sum(CASE WHEN sub AND clean <> before THEN 1 ELSE 0 END) OVER
          (PARTITION BY parent ORDER BY original_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS suffix FROM step{tag}),
final{tag} AS (SELECT *, CASE WHEN NOT sub THEN code_ref ELSE parent || CAST(suffix AS VARCHAR) END AS code_final FROM count{tag}),
found{tag} AS (SELECT f.*, designation_v2 AS indicator_name, unite_v2 AS unit_found FROM final{tag} f LEFT JOIN items{tag} i ON f.code_final = i.ref),
coded{tag} AS (
  SELECT row_idx, var_pos, {recoded} AS indicator_code, indicator_name, unit AS unit_original,
         last_value(unit_found IGNORE NULLS) OVER (ORDER BY var_pos, row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS unit_ref,
         country, value, value_type, {year} AS year, original_order, {changed} AS indicator_changed
  FROM (SELECT r.*, f.code_final, f.code_ref_new, f.note, f.indicator_name, f.unit_found FROM {rows} r LEFT JOIN found{tag} f
        ON r.name = f.name AND r.code = f.code AND r.original_order = f.original_order))
"""


CODED_2025_SQL = f"{META_SQL}, {ROWS_2025_SQL}, {codes_sql('rows25', '25', True, '2025')}"
CODED_2026_SQL = f"{ROWS_2026_SQL}, {codes_sql('rows26', '26', False, 'year')}"
_CODED = [
    "row_idx", "var_pos", "indicator_code", "indicator_name", "unit_original", "unit_ref", "country", "value",
    "value_type", "year", "original_order", "indicator_changed",
]


@query("sheet_2025_codes", f"WITH {CODED_2025_SQL} SELECT * FROM coded25")
def sheet_2025_codes(spark, sf):
    return assign_codes(results_sheet_2025(grid_2025(spark, sf)), metadata(spark), True).select(*_CODED)


@query("sheet_2026_codes", f"WITH {META_SQL}, {CODED_2026_SQL} SELECT * FROM coded26")
def sheet_2026_codes(spark, sf):
    return assign_codes(targets_sheet_2026(grid_2026(spark, sf)), metadata(spark), False).select(*_CODED)


_LANDS = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in fixed.COUNTRY_OF_SHEET_CODE.items())


@query(
    "official_results",
    f"""WITH {CODED_2025_SQL}, r AS (SELECT * REPLACE (CASE country {_LANDS} ELSE country END AS country) FROM coded25 WHERE value_type = 'result')
    SELECT indicator_code, indicator_name, unit_ref AS unit, year, year || '-01-01' AS date, 'new' AS project,
           CASE WHEN contains(country, 'Régional') THEN 1 ELSE 2 END AS level, country,
           CASE WHEN unit_original ILIKE '%million%' THEN value * 1000000 WHEN unit_original ILIKE '%millier%' THEN value * 1000
                WHEN unit_original ILIKE '%pourcent%' THEN value / 100 ELSE value END AS value, indicator_changed FROM r""",
)
def official_results(spark, sf):
    coded = assign_codes(results_sheet_2025(grid_2025(spark, sf)), metadata(spark), True)
    return results_table(coded, "new")


_UNITS = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in fixed.UNIT_LABELS.items())
_TYPES = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in fixed.INDICATOR_TYPES.items())
_COMPONENTS = " ".join(
    f"WHEN indicator_code IN ({', '.join(map(_quoted, codes))}) THEN {_quoted(c)}" for c, codes in fixed.COMPONENT_CODES.items()
)


@query(
    "targets_combine",
    f"""WITH {CODED_2025_SQL}, {CODED_2026_SQL},
    every AS (SELECT * FROM coded25 WHERE value_type = 'target' UNION ALL BY NAME SELECT * FROM coded26),
    cleaned AS (SELECT *, trim(regexp_replace(unit_original, '\\s+', ' ', 'g')) AS u FROM every),
    named AS (SELECT *, CASE u {_UNITS} ELSE u END AS unite FROM cleaned)
    SELECT indicator_code AS "Code", indicator_name AS "Indicateur_Name", country AS "Pays", CASE {_COMPONENTS} END AS "Composante", year AS "année",
           CASE WHEN unite ILIKE '%millier%' THEN value * 1000 ELSE value END AS valeur, unite,
           CASE unit_ref {_TYPES} ELSE unit_ref END AS indicator_type, false AS "cumulative values", indicator_changed FROM named""",
)
def targets_combine(spark, sf):
    _, targets = framework_tables(grid_2025(spark, sf), grid_2026(spark, sf), metadata(spark), "new")
    return targets


# --- the report ----------------------------------------------------------------------

_REPORT_CODE = "CASE l_linenumber WHEN 1 THEN 'IR-1' WHEN 2 THEN 'IR-2' WHEN 3 THEN 'IRI-5' WHEN 4 THEN 'Reg Int 1' WHEN 5 THEN 'IRI-18' WHEN 6 THEN 'IRI-7' ELSE 'ZZZ' END"
_REPORT_UNIT = "CASE l_linenumber WHEN 1 THEN 'Pourcentage' WHEN 2 THEN (CASE WHEN l_suppkey % 7 = 0 THEN 'Nombre (MILLIONS)' ELSE 'Nombre' END) WHEN 3 THEN 'hectares (milliers)' WHEN 5 THEN NULL ELSE 'Nombre' END"
# the order of the lines: later years first, and of a year a unit that is not the smallest
_LINE = "(2030 - (year(l_shipdate) + 26)) * 10 + (l_suppkey % 7) * 3 % 7"
_VALUE_CODE = "CASE o_orderpriority WHEN '1-URGENT' THEN 'IR-1' WHEN '2-HIGH' THEN 'IR-2' WHEN '3-MEDIUM' THEN 'IRI-5' WHEN '5-LOW' THEN 'Reg Int 1' ELSE 'IRI-18' END"
_CODES = [k for _, k in fixed.REPORT_COUNTRIES]
_NAMES = [c for c, _ in fixed.REPORT_COUNTRIES]


def _nth(key: str, names: list[str]) -> str:
    return f"CASE {key} % 7 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def report_targets(spark, sf):
    qty = F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0.0)
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            F.expr(_REPORT_CODE).alias("Code"),
            F.expr(_nth("l_suppkey", _CODES)).alias("Pays"),
            (F.year("l_shipdate") + 26).alias("année"),
            F.expr(_REPORT_UNIT).alias("unite"),
            F.expr(_LINE).alias("line"),
        )
        .agg(F.sum(F.when(F.year("l_shipdate") != 1998, qty).otherwise(0.0)).alias("valeur"))
    )


def report_values(spark, sf):
    value = F.sum(F.floor("o_totalprice").cast("double"))
    # the quotient of nothing by nothing, as the cumulation leaves it
    running = (
        F.when(F.col("level") == 2, F.when(F.col("year") == 2023, float("nan")).when(F.col("year") == 2024, F.lit(None)).otherwise(F.col("value") * 2))
    )
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.expr(_VALUE_CODE).alias("indicator_code"),
            F.expr(_nth("o_custkey", _NAMES)).alias("country"),
            (F.year("o_orderdate") + 26).alias("year"),
        )
        .agg(value.alias("value"))
        .withColumn("level", F.when(F.col("country") == fixed.TOP_PLACE, 1).otherwise(2))
        .withColumn("cumulative_value_new", running)
    )


_LABELS = (("IR-1", "Taux"), ("IRI-18", "Plaintes"), ("IRI-5", None), ("other", "Autre"))

_LAYOUT = [
    (section, label, component, code)
    for section, label, components in fixed.REPORT_LAYOUT
    for component, codes in components
    for code in codes
]

REPORT_SQL = f"""
layout(ord, section, section_label, component, indicator_code) AS (VALUES {", ".join(
    f"({i}, " + ", ".join(_quoted(v) for v in line) + ")" for i, line in enumerate(_LAYOUT))}),
lands(country_ord, country, country_code) AS (VALUES {", ".join(
    f"({i}, {_quoted(c)}, {_quoted(k)})" for i, (c, k) in enumerate(fixed.REPORT_COUNTRIES))}),
labels(code, label) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in _LABELS)}),
targets AS (SELECT {_REPORT_CODE} AS code, {_nth("l_suppkey", _CODES)} AS pays, year(l_shipdate) + 26 AS y, {_REPORT_UNIT} AS unite, {_LINE} AS line,
            sum(CASE WHEN l_returnflag = 'A' AND year(l_shipdate) <> 1998 THEN l_quantity ELSE 0 END) AS valeur FROM lineitem GROUP BY ALL),
vals AS (SELECT {_VALUE_CODE} AS code, {_nth("o_custkey", _NAMES)} AS country, year(o_orderdate) + 26 AS y, sum(floor(o_totalprice)) AS value
         FROM orders GROUP BY ALL),
spine AS (SELECT *, CAST(unnest(generate_series(2022, 2027)) AS INTEGER) AS year FROM layout, lands
          WHERE indicator_code NOT LIKE 'Reg%' OR country = 'Régional'),
raw AS (SELECT s.*, l.label, u.unite AS unit, t.valeur AS target,
          CASE WHEN s.indicator_code NOT LIKE 'Reg%' AND s.country <> 'Régional' AND s.year NOT IN (2023, 2024) THEN v.value * 2 ELSE v.value END AS value
        FROM spine s LEFT JOIN labels l ON l.code = s.indicator_code
        LEFT JOIN (SELECT code, arg_min(unite, line) AS unite FROM targets GROUP BY code) u ON u.code = s.indicator_code
        LEFT JOIN targets t ON t.code = s.indicator_code AND t.pays = s.country_code AND t.y = s.year
        LEFT JOIN vals v ON v.code = s.indicator_code AND v.country = s.country AND v.y = s.year),
scaled AS (SELECT * REPLACE (
     CASE WHEN unit = 'Pourcentage' THEN value * 100 WHEN unit ILIKE '%millions%' THEN value / 1000000 WHEN unit ILIKE '%milliers%' THEN value / 1000 ELSE value END AS value,
     CASE WHEN unit ILIKE '%millions%' THEN target / 1000000 WHEN unit ILIKE '%milliers%' THEN target / 1000 ELSE target END AS target) FROM raw),
report AS (SELECT *, CASE WHEN target <> 0 THEN round(value / target, 3) END AS ratio FROM scaled)
"""


def _report(spark, sf):
    meta = fixed_table(spark, _LABELS, "code string, designation string")
    return target_vs_result(report_targets(spark, sf), report_values(spark, sf), meta, "new")


@query("target_vs_result", f"WITH {REPORT_SQL} SELECT * FROM report")
def target_vs_result_report(spark, sf):
    return _report(spark, sf)


@query(
    "report_wide",
    f"""WITH {REPORT_SQL} SELECT ord, section, section_label, component, indicator_code, label, unit, country_ord, country, """
    + ", ".join(f'max(CASE WHEN year = {y} THEN {m} END) AS "{y}_{m}"' for y in fixed.REPORT_YEARS for m in ("target", "value", "ratio"))
    + " FROM report GROUP BY ALL",
)
def report_wide(spark, sf):
    return wide_report(_report(spark, sf))


# --- pictures ------------------------------------------------------------------------

_PICTURES = """'[{{"download_url":' || CASE WHEN {k} % 5 = 0 THEN 'null' WHEN {k} % 5 = 1 THEN '"http://x/placeholder.png"' ELSE '"http://x/' || CAST({k} AS {t}) || '"' END
    || ',"filename":"a/b/p' || CAST({k} AS {t}) || '.jpg","size":3}},{{"download_url":"http://y/' || CAST({k} AS {t}) || '","filename":"p' || CAST({k} * 2 AS {t}) || '.jpg"}}]'"""


def _listed_sql(survey, source, key):
    return f"""
    SELECT '{survey}' AS survey, 'http://x/' || {key} AS download_url, 'p' || {key} || '.jpg' AS file_name FROM {source} WHERE {key} % 5 > 1
    UNION ALL SELECT '{survey}', 'http://y/' || {key}, 'p' || ({key} * 2) || '.jpg' FROM {source}"""


@query(
    "attachment_manifest",
    f"""WITH listed AS ({_listed_sql("pages", "pages", "page_id")} UNION ALL {_listed_sql("documents", "documents", "doc_id")})
    SELECT * FROM listed WHERE file_name NOT IN (SELECT 'p' || o_custkey || '.jpg' FROM orders WHERE o_orderstatus = 'F')""",
)
def attachment_manifest(spark, sf):
    def with_pictures(source, key):
        return table(spark, sf, source).select(F.expr(_PICTURES.format(k=key, t="STRING")).alias("_attachments"))

    present = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        F.concat(F.lit("p"), F.col("o_custkey").cast("string"), F.lit(".jpg")).alias("file_name")
    )
    surveys = {"pages": with_pictures("pages", "page_id"), "documents": with_pictures("documents", "doc_id")}
    return fetch_manifest(surveys, present)


_PATH = "'s3://bucket/in/' || CAST(doc_id AS {t}) || CASE doc_id % 5 WHEN 0 THEN '.jpg' WHEN 1 THEN '.JPEG' WHEN 2 THEN '.png' WHEN 3 THEN '.txt' ELSE '' END"


@query(
    "upload_manifest",
    f"""WITH f AS (SELECT {_PATH.format(t='VARCHAR')} AS path FROM documents), n AS (SELECT path, array_extract(string_split(path, '/'), -1) AS file_name FROM f)
    SELECT path, file_name FROM n WHERE regexp_matches(lower(file_name), '\\.(jpg|jpeg|png)$')
    AND file_name NOT IN (SELECT doc_id || '.jpg' FROM labels WHERE quality = 1)""",
)
def upload_manifest(spark, sf):
    paths = table(spark, sf, "documents").select(F.expr(_PATH.format(t="STRING")).alias("path"))
    published = table(spark, sf, "labels").filter("quality = 1").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".jpg")).alias("file_name")
    )
    return publish_manifest(paths, published)


# --- fingerprints ----------------------------------------------------------------------


#: every column of lineitem, and a date, a decimal and columns with nulls made from them
_PRINTED = {
    "l_discount": ("double", "l_discount"),
    "l_extendedprice": ("double", "l_extendedprice"),
    "l_linenumber": ("int", "l_linenumber"),
    "l_linestatus": ("string", "l_linestatus"),
    "l_orderkey": ("bigint", "l_orderkey"),
    "l_partkey": ("bigint", "l_partkey"),
    "l_quantity": ("double", "l_quantity"),
    "l_returnflag": ("string", "l_returnflag"),
    "l_shipdate": ("timestamp_ntz", "l_shipdate"),
    "l_suppkey": ("bigint", "l_suppkey"),
    "l_tax": ("double", "l_tax"),
    "note": ("string", "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_returnflag || l_linestatus END"),
    "price": ("decimal(12,2)", "CAST(l_extendedprice AS DECIMAL(12,2))"),
    "shipped": ("date", "CASE WHEN l_linenumber % 3 = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) END"),
}
_ROW_TEXT = " || ';' || ".join(
    f"'{c}={kind}=' || coalesce(length(CAST({sql} AS VARCHAR)) || ':' || CAST({sql} AS VARCHAR), '-')" for c, (kind, sql) in _PRINTED.items()
)


@query(
    "publish_fingerprint",
    f"""WITH d AS (SELECT md5({_ROW_TEXT}) AS d FROM lineitem),
    h AS (SELECT CAST(CAST('0x' || substr(d, 1, 15) AS BIGINT) AS HUGEINT) AS h, CAST(CAST('0x' || substr(d, 17, 15) AS BIGINT) AS HUGEINT) AS i FROM d)
    SELECT count(*) AS n_rows, CAST(sum(h) AS VARCHAR) || '-' || CAST(sum(i) AS VARCHAR) AS content,
           '{",".join(f"{c}:{kind}" for c, (kind, _) in _PRINTED.items())}' AS columns FROM h""",
)
def publish_fingerprint(spark, sf):
    """Of whole rows of lineitem, with more columns so that every kind of value is hashed."""
    made = {c: F.expr(sql) for c, (_, sql) in _PRINTED.items() if c != sql}
    return fingerprint(table(spark, sf, "lineitem").withColumns(made))
