"""Cleaning of texts and numbers, nested values, lookups by fixed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmark.functions.lookup import member_of, relabel
from fieldmark.functions.nested import doubles_from_json, last_segment, public_url, to_json_or_null
from fieldmark.functions.numeric import floor_bucket, ieee_div, nan_to_null
from fieldmark.functions.text import (
    contains_any_case,
    first_number,
    normalise_label,
    plain_number,
    replace_first,
    squeeze,
    strip,
)
from fieldmark.operators.resolve import MetadataColumns, main_items, match_names
from fieldmark.plans import fixed_values as fixed
from fieldmark.plans.framework import scaled_result
from fieldmark.plans.report import in_unit
from fieldmark.schema import fixed_table

from .registry import query, table

# one token per word or per run of other signs; then word by word
_TOKENS = r"[\p{L}\p{M}\p{Nd}\p{Pc}]+|[^\p{L}\p{M}\p{Nd}\p{Pc}]+"
_WORD = r"^[\p{L}\p{M}\p{Nd}\p{Pc}]"
_SPACE = r"[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def label_sql(text: str) -> str:
    """The label normaliser in SQL: the text as a list of words, each treated by CASE."""
    plain = (
        f"translate(lower(regexp_replace({text}, '^{_SPACE}+|{_SPACE}+$', '', 'g')), 'éèêëàâäîïôöùûüç', 'eeeeaaaiioouuuc')"
    )
    singular = """CASE WHEN w IN ('plus', 'moins', 'prix', 'sous', 'taux') THEN w
        WHEN w LIKE '%aux' THEN left(w, length(w) - 3) || 'al'
        WHEN w LIKE '%xs' THEN left(w, length(w) - 2)
        WHEN w LIKE '%s' OR w LIKE '%x' THEN left(w, length(w) - 1) ELSE w END"""
    links = "('de', 'du', 'des', 'et', 'le', 'la', 'les', 'pour', 'au', 'ou')"
    words = f"list_transform(regexp_extract_all({plain}, '{_TOKENS}'), lambda w: {singular})"
    linked = f"list_transform({words}, lambda w: CASE WHEN w IN {links} THEN ' ' WHEN regexp_matches(w, '{_WORD}') THEN w ELSE regexp_replace(w, '[^\\s\\x{{000B}}\\x{{0085}}\\x{{00A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', '', 'g') END)"
    joined = f"array_to_string({linked}, '')"
    return f"trim(regexp_replace({joined}, '{_SPACE}+', ' ', 'g'))"


@query("label_normalise", f"SELECT doc_id, lang, {label_sql('text')} AS label FROM documents")
def label_normalise(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", normalise_label(F.col("text")).alias("label"))


@query(
    "strip_and_squeeze",
    f"""SELECT conv_id, turn, trim(regexp_replace(text, '{_SPACE}+', ' ', 'g'), ' ') AS squeezed,
        CASE WHEN instr(text, ',') > 0 THEN left(text, instr(text, ',') - 1) || '.' || substr(text, instr(text, ',') + 1) ELSE text END AS pointed
        FROM conversations""",
)
def strip_and_squeeze(spark, sf):
    text = F.col("text")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", strip(squeeze(text)).alias("squeezed"), replace_first(text, ",", ".").alias("pointed")
    )


# --- names to codes ----------------------------------------------------------------

#: former name and code, new name and code, unit, note
_META = (
    ("  Les Petites Bagues ", "B-1", "Bagues", "B-2", "count", "nouveau code d'indicateur"),
    ("Small Rings", "R-1", "Rings", "R-2", "count", None),
    ("OLD, Anvil!", "A-1", "Anvils", "A-2", "weight", "indicateur changé"),
    ("hot   plates", "P-1", "Plates", "P-2", "percent", None),
    ("Hot Plate", "P-9", "Plate", "P-8", "percent", None),
    ("Dont blue rods", "D-1", "Rods", "D-2", "count", None),
)
_OVERRIDES = {"red widget": "W-1", "small ring": "R-9"}
_META_NAMES = ("designation", "code", "designation_v2", "code_v2", "unite_v2", "note")


def _quoted(value):
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_META_VALUES = ", ".join("(" + ", ".join(_quoted(v) for v in row) + ")" for row in _META)


@query(
    "name_match_codes",
    f"""WITH meta({', '.join(_META_NAMES)}) AS (VALUES {_META_VALUES}),
    items AS (SELECT *, {label_sql('designation')} AS clean FROM meta),
    names AS (SELECT p_partkey, p_name, {label_sql('p_name')} AS clean FROM part)
    SELECT p_partkey, p_name, n.clean, CASE p_name WHEN 'red widget' THEN 'W-1' WHEN 'small ring' THEN 'R-9' ELSE code END AS code_ref,
           code_v2 AS code_ref_new, note
    FROM names n LEFT JOIN (SELECT * FROM items WHERE NOT starts_with(clean, 'dont ')) i ON n.clean = i.clean""",
)
def name_match_codes(spark, sf):
    meta = fixed_table(spark, _META, ", ".join(f"{c} string" for c in _META_NAMES))
    items = main_items(meta, MetadataColumns("designation", "code"))
    names = table(spark, sf, "part").select("p_partkey", "p_name")
    return match_names(names, items, "p_name", _OVERRIDES)


# --- numbers -----------------------------------------------------------------------

_CELL = """CASE WHEN event_type = 'error' THEN 'Oui' WHEN event_type = 'signup' THEN 'NON'
    WHEN event_type = 'view' THEN '-' || CAST(value AS {text}) WHEN event_type = 'click' THEN replace(CAST(value AS {text}), '.', ',')
    ELSE CAST(event_id AS {text}) || ' ha' END"""


@query(
    "lenient_number",
    f"""WITH c AS (SELECT event_id, {_CELL.format(text='VARCHAR')} AS cell FROM events)
    SELECT event_id, cell, CASE lower(cell) WHEN 'oui' THEN 1.0::DOUBLE WHEN 'non' THEN 0.0::DOUBLE ELSE
           TRY_CAST(nullif(regexp_extract(CASE WHEN instr(cell, ',') > 0 THEN left(cell, instr(cell, ',') - 1) || '.' || substr(cell, instr(cell, ',') + 1) ELSE cell END,
           '([0-9]+\\.?[0-9]*)', 1), '') AS DOUBLE) END AS first_number,
           CASE lower(cell) WHEN 'oui' THEN 1.0::DOUBLE WHEN 'non' THEN 0.0::DOUBLE ELSE TRY_CAST(cell AS DOUBLE) END AS plain_number
    FROM c""",
)
def lenient_number(spark, sf):
    cells = table(spark, sf, "events").select("event_id", F.expr(_CELL.format(text="STRING")).alias("cell"))
    return cells.select(
        "event_id", "cell", first_number(F.col("cell")).alias("first_number"), plain_number(F.col("cell")).alias("plain_number")
    )


@query(
    "first_number_in_text",
    r"""WITH t AS (SELECT doc_id, lower(text) AS x FROM documents),
    p AS (SELECT doc_id, CASE WHEN instr(x, ',') > 0 THEN left(x, instr(x, ',') - 1) || '.' || substr(x, instr(x, ',') + 1) ELSE x END AS x FROM t)
    SELECT doc_id, TRY_CAST(nullif(regexp_extract(x, '(\p{Nd}+\.?\p{Nd}*)', 1), '') AS DOUBLE) AS number FROM p""",
)
def first_number_in_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", first_number(F.col("text")).alias("number"))


@query(
    "yes_no_to_number",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 0.0::DOUBLE ELSE o_totalprice END AS value FROM orders""",
)
def yes_no_to_number(spark, sf):
    cell = F.expr("CASE o_orderstatus WHEN 'F' THEN 'OUI' WHEN 'O' THEN 'Non' ELSE CAST(o_totalprice AS STRING) END")
    return table(spark, sf, "orders").select("o_orderkey", plain_number(cell).alias("value"))


@query(
    "division_with_null_rules",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN user_id = 0 THEN NULL ELSE value / user_id END AS quotient,
              (event_id // 100) * 100 AS bucket FROM events""",
)
def division_with_null_rules(spark, sf):
    """Quotients as floating point has them, without those that are no number."""
    value = F.when(F.col("event_type") != "error", F.when(F.col("user_id") == 0, 0.0).otherwise(F.col("value")))
    return table(spark, sf, "events").select(
        "event_id",
        nan_to_null(ieee_div(value, F.col("user_id"))).alias("quotient"),
        floor_bucket(F.col("event_id"), 100).alias("bucket"),
    )


_UNIT = "CASE l_returnflag WHEN 'A' THEN 'Têtes (MILLIONS)' WHEN 'N' THEN 'Pourcentage' WHEN 'R' THEN CASE WHEN l_linenumber = 1 THEN NULL ELSE 'hectares (milliers)' END END"


@query(
    "unit_scaling",
    f"""WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS q, {_UNIT} AS unit FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, unit,
      CASE WHEN unit ILIKE '%million%' THEN q * 1000000 WHEN unit ILIKE '%millier%' THEN q * 1000 WHEN unit ILIKE '%pourcent%' THEN q / 100 ELSE q END AS base_value,
      CASE WHEN unit = 'Pourcentage' THEN q * 100 WHEN lower(unit) LIKE '%millions%' THEN q / 1000000 WHEN lower(unit) LIKE '%milliers%' THEN q / 1000 ELSE q END AS shown_value,
      CASE WHEN lower(unit) LIKE '%millions%' THEN q / 1000000 WHEN lower(unit) LIKE '%milliers%' THEN q / 1000 ELSE q END AS shown_target
    FROM u""",
)
def unit_scaling(spark, sf):
    q, unit = F.col("l_quantity"), F.col("unit")
    lines = table(spark, sf, "lineitem").withColumn("unit", F.expr(_UNIT))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "unit",
        scaled_result(q, unit).alias("base_value"),
        in_unit(q, unit, is_value=True).alias("shown_value"),
        in_unit(q, unit, is_value=False).alias("shown_target"),
    )


# --- fixed tables ------------------------------------------------------------------

_COMPONENTS = ", ".join(
    f"('{code}', '{component}')" for component, codes in fixed.COMPONENT_CODES.items() for code in codes
)
_TYPES = ", ".join(f"('{k}', '{v}')" for k, v in fixed.INDICATOR_TYPES.items())
_COUNTRIES = ", ".join(f"('{k}', '{v}')" for k, v in fixed.COUNTRY_OF_SHEET_CODE.items())
_CODE = "CASE WHEN p_size > 40 THEN 'Reg Int ' || CAST(p_size - 40 AS {t}) ELSE 'IRI-' || CAST(p_size AS {t}) END"
_SHEET_COUNTRY = "CASE p_type WHEN 'ECONOMY' THEN 'BF' WHEN 'PROMO' THEN 'MR Restruct*' WHEN 'SMALL' THEN 'REGIONAL restruc' WHEN 'LARGE' THEN 'ZZ' ELSE NULL END"
_KIND = "CASE p_type WHEN 'ECONOMY' THEN 'count' WHEN 'PROMO' THEN 'percent' WHEN 'SMALL' THEN 'boolean' ELSE p_name END"


@query(
    "component_lookup",
    f"""WITH comp(code, component) AS (VALUES {_COMPONENTS}), types(k, v) AS (VALUES {_TYPES}), lands(k, v) AS (VALUES {_COUNTRIES}),
    p AS (SELECT p_partkey, {_CODE.format(t='VARCHAR')} AS code, {_SHEET_COUNTRY} AS c, {_KIND} AS kind FROM part)
    SELECT p_partkey, p.code, component, coalesce(lands.v, c) AS country, coalesce(types.v, kind) AS indicator_type
    FROM p LEFT JOIN comp ON p.code = comp.code LEFT JOIN types ON kind = types.k LEFT JOIN lands ON c = lands.k""",
)
def component_lookup(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.expr(_CODE.format(t="STRING")).alias("code"), F.expr(_SHEET_COUNTRY).alias("c"), F.expr(_KIND).alias("kind"))
    return parts.select(
        "p_partkey",
        "code",
        member_of(F.col("code"), fixed.COMPONENT_CODES).alias("component"),
        relabel(F.col("c"), fixed.COUNTRY_OF_SHEET_CODE).alias("country"),
        relabel(F.col("kind"), fixed.INDICATOR_TYPES).alias("indicator_type"),
    )


@query(
    "note_flags",
    """SELECT doc_id, regexp_matches(text, '(?i)été|mentéré') AS marked FROM documents""",
)
def note_flags(spark, sf):
    return table(spark, sf, "documents").select("doc_id", contains_any_case(F.col("text"), "été", "mentéré").alias("marked"))


# --- nested values -----------------------------------------------------------------


@query(
    "nested_to_json",
    """SELECT conv_id, turn, '{"conv_id":' || conv_id || ',"role":"' || role || '","next":' ||
              CASE WHEN turn = 0 THEN 'null' ELSE CAST(turn AS VARCHAR) END || '}' AS as_json,
              CASE WHEN turn > 0 THEN '["' || role || '"]' END AS as_list FROM conversations""",
)
def nested_to_json(spark, sf):
    chats = table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.struct("conv_id", "role", F.when(F.col("turn") != 0, F.col("turn")).alias("next")).alias("s"),
        F.filter(F.array(F.when(F.col("turn") > 0, F.col("role"))), lambda e: e.isNotNull()).alias("l"),
    )
    kinds = chats.schema
    return chats.select(
        "conv_id",
        "turn",
        to_json_or_null(F.col("s"), kinds["s"].dataType).alias("as_json"),
        to_json_or_null(F.col("l"), kinds["l"].dataType).alias("as_list"),
    )


@query(
    "embeddings_to_json",
    """SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS n, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[-1] AS DOUBLE) AS last_value,
       CAST(list_min(embedding) AS DOUBLE) AS least_value, CAST(list_max(embedding) AS DOUBLE) AS greatest_value, true AS unchanged FROM embeddings""",
)
def embeddings_to_json(spark, sf):
    """Written as text and read back, as the engines print floats differently."""
    vectors = table(spark, sf, "embeddings")
    kind = vectors.schema["embedding"].dataType
    told = vectors.withColumn("text", to_json_or_null(F.col("embedding"), kind)).withColumn("back", F.from_json("text", "array<float>"))
    return told.select(
        "vec_id",
        "label",
        F.size("back").alias("n"),
        F.get("back", F.lit(0)).cast("double").alias("first_value"),
        F.element_at("back", -1).cast("double").alias("last_value"),
        F.array_min("back").cast("double").alias("least_value"),
        F.array_max("back").cast("double").alias("greatest_value"),
        (F.col("back") == F.col("embedding").cast("array<float>")).alias("unchanged"),
    )


@query(
    "json_fields",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS DOUBLE) AS lat, CAST(user_id AS DOUBLE) AS lon FROM events""",
)
def json_fields(spark, sf):
    k = F.from_json("props", "k bigint")["k"]
    point = doubles_from_json(F.concat(F.lit("["), k.cast("string"), F.lit(","), F.col("user_id").cast("string"), F.lit("]")))
    return table(spark, sf, "events").select(
        "event_id", k.alias("k"), F.get(point, F.lit(0)).alias("lat"), F.get(point, F.lit(1)).alias("lon")
    )


@query(
    "url_prefix_placeholder",
    """WITH p AS (SELECT page_id, url, CASE WHEN contains(url, '#') THEN NULL WHEN contains(url, '?') THEN '' ELSE array_extract(string_split(url, '/'), -1) END AS file FROM pages)
       SELECT page_id, array_extract(string_split(url, '/'), -1) AS last, CASE WHEN file IS NULL OR file = '' THEN 'https://pictures.example.org/placeholder.png'
              ELSE 'https://pictures.example.org/' || file END AS picture FROM p""",
)
def url_prefix_placeholder(spark, sf):
    url = F.col("url")
    file = F.when(~url.contains("#"), F.when(url.contains("?"), "").otherwise(last_segment(url)))
    return table(spark, sf, "pages").select(
        "page_id", last_segment(url).alias("last"), public_url(file, "https://pictures.example.org/").alias("picture")
    )
