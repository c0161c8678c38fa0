"""The whole job: nine surveys, history, metadata and official figures to the published table."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmark.functions.numeric import nan_to_null
from fieldmark.plans.catalogue import DEFINITIONS
from fieldmark.plans.indicators import Projects, history_facts, indicator_table
from fieldmark.schema import fixed_table

from .catalogue import WITH_HISTORY_SQL, every_table, history_view
from .registry import query, table

OLD, NEW = "old", "new"
FIRST, LAST_OLD = 2021, 2021

#: codes whose unit is not the count; all kinds of units are there
_UNITS = {
    "IR-1": "percent", "IR-3": "surface", "IR-4": "weight", "IRI-1": "percent", "IRI-9": "percent", "IRI-15": "boolean", "IRI-16": "percent",
    "IRI-17": "percent", "IRI-18": "other", "Reg Int 2": "percent", "Reg Int 4": "boolean",
}
_NOTES = {"IRI-3": "Indicateur changé", "IRI-13": "INDICATEUR SUPPRIMÉ en 2025", "IRI-2": "rien"}
#: the history's code Reg Int 7 is not among them
_META = tuple(
    (code, f"N-{code}" if code == "IRI-5" else code, f"name of {code}", _UNITS.get(code, "count"), _NOTES.get(code))
    for code in dict.fromkeys(d.code for d in DEFINITIONS)
)


def _quoted(value):
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


_META_SQL = "meta(code, code_v2, name, unit, note) AS (VALUES " + ", ".join("(" + ", ".join(map(_quoted, row)) + ")" for row in _META) + ")"

_OFFICIAL = "CASE o_orderstatus WHEN 'F' THEN 'IR-2' WHEN 'O' THEN 'IRI-1' ELSE 'IR-4' END"


def _step(source: str, country: str, region: str, stage: int, level: int) -> str:
    by = f"code, unit, date, project, {country}, {region}"
    head = f"SELECT code, unit, date, project, {country} AS country, {region} AS region, {level} AS level, {stage} AS stage"
    none = "CAST(NULL AS DOUBLE)"
    kinds = (
        ("unit IN ('count', 'weight', 'surface')", f"{none} AS num, {none} AS den, coalesce(sum(value), 0) AS value"),
        ("unit = 'percent' AND num IS NOT NULL AND den IS NOT NULL", "sum(num) AS num, sum(den) AS den, CASE WHEN sum(den) <> 0 THEN sum(num) / sum(den) END AS value"),
        ("unit = 'percent' AND (num IS NULL OR den IS NULL)", f"{none} AS num, {none} AS den, avg(value) AS value"),
        ("unit = 'boolean'", f"{none} AS num, {none} AS den, CAST(coalesce(min(value), 1) <> 0 AS INTEGER)::DOUBLE AS value"),
    )
    return " UNION ALL ".join(
        f"{head}, 1 AS rank, {i} AS kind, {what} FROM {source} WHERE {where} GROUP BY {by}" for i, (where, what) in enumerate(kinds, start=1)
    )


def _running(condition: str, column: str) -> str:
    """A running sum in millionths, as whole numbers."""
    return f"CAST(sum(CASE WHEN {condition} THEN CAST(round(coalesce({column}, 0) * 1000000) AS HUGEINT) ELSE 0 END) OVER w AS DOUBLE) / 1000000"


_NO_PLACE = "CAST(NULL AS VARCHAR)"
JOB_SQL = f"""
WITH {_META_SQL},
facts AS MATERIALIZED (
  SELECT code_v2 AS code, unit, CAST(substr(f.date, 1, 4) AS INTEGER) AS date, project, level, country, region, numerator AS num, denominator AS den, value, src_rank AS rank
  FROM ({WITH_HISTORY_SQL}) f LEFT JOIN meta ON f.indicator_code = meta.code),
base AS (SELECT *, 0 AS stage, 0 AS kind FROM facts WHERE level <= 3),
sites AS (SELECT * FROM facts WHERE level = 6),
l3 AS MATERIALIZED ({_step('sites', 'country', 'region', 1, 3)}),
in2 AS (SELECT * FROM base WHERE level = 3 UNION ALL BY NAME SELECT * FROM l3),
l2 AS MATERIALIZED ({_step('in2', 'country', _NO_PLACE, 2, 2)}),
in1 AS (SELECT * FROM base WHERE level = 2 UNION ALL BY NAME SELECT * FROM l2),
l1 AS ({_step('in1', "'Régional'", _NO_PLACE, 3, 1)}),
every AS (SELECT * FROM base UNION ALL BY NAME SELECT * FROM l3 UNION ALL BY NAME SELECT * FROM l2 UNION ALL BY NAME SELECT * FROM l1),
rolled AS MATERIALIZED (SELECT code, unit, date, project, level, country, region, num, den, value FROM every
  QUALIFY row_number() OVER (PARTITION BY code, date, level, country, region ORDER BY stage, rank, kind, unit NULLS FIRST, project, value NULLS FIRST, num NULLS FIRST, den NULLS FIRST) = 1),
codes AS (SELECT code, min(unit) AS unit, max(level) AS deepest FROM rolled WHERE code IS NOT NULL GROUP BY code),
countries AS (SELECT DISTINCT country FROM rolled WHERE level = 2),
years AS (SELECT CAST(unnest(generate_series({FIRST}, (SELECT max(date) FROM rolled))) AS INTEGER) AS date),
spine AS (
  SELECT code, unit, date, 1 AS level, 'Régional' AS country, {_NO_PLACE} AS region FROM codes, years
  UNION ALL SELECT code, unit, date, 2, country, NULL FROM codes, years, countries WHERE deepest >= 2
  UNION ALL SELECT code, unit, date, 3, country, region FROM (SELECT DISTINCT r.code, c.unit, r.country, r.region FROM rolled r JOIN codes c USING (code)
    WHERE c.deepest >= 3 AND r.region <> '' AND r.country IN (SELECT country FROM countries)), years),
filled AS (
  SELECT * FROM rolled
  UNION ALL BY NAME SELECT s.*, CASE WHEN date <= {LAST_OLD} THEN '{OLD}' ELSE '{NEW}' END AS project FROM spine s
  WHERE NOT EXISTS (SELECT 1 FROM rolled r WHERE r.code = s.code AND r.date = s.date AND r.country IS NOT DISTINCT FROM s.country AND r.region IS NOT DISTINCT FROM s.region)),
official AS (SELECT {_OFFICIAL} AS code, CAST(year(o_orderdate) + 24 AS INTEGER) AS date, o_orderpriority AS country, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY ALL),
merged AS (
  SELECT *, 'survey' AS data_source FROM filled WHERE NOT coalesce(code IN (SELECT code FROM official) AND date IN (SELECT date FROM official) AND country IN (SELECT country FROM official), false)
  UNION ALL BY NAME SELECT o.code, m.unit, date, '{NEW}' AS project, 2 AS level, country, value, 'official' AS data_source FROM official o JOIN meta m ON m.code = o.code),
known AS (SELECT *, unit IN ('count', 'weight', 'surface') AS adds, unit = 'percent' AND project = '{NEW}' AS r FROM merged WHERE unit <> 'other'),
summed AS (
  SELECT *, {_running("adds", "value")} AS all_sum, {_running(f"adds AND project = '{NEW}'", "value")} AS new_sum, {_running("r", "num")} AS n, {_running("r", "den")} AS d
  FROM known WINDOW w AS (PARTITION BY level, code, country, region ORDER BY date NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
shares AS (SELECT *, CASE WHEN d <> 0 THEN n / d END AS q FROM summed)
SELECT s.code AS indicator_code, m.name AS indicator_name, s.unit, date AS year, date || '-01-01' AS date, project, level, country, region,
  round(num, 3) AS numerator, round(den, 3) AS denominator, round(value, 3) AS value,
  round(CASE WHEN r THEN n END, 3) AS cumulative_numerator, round(CASE WHEN r THEN d END, 3) AS cumulative_denominator,
  round(CASE WHEN unit_is_flag OR (adds AND data_source = 'official') THEN value WHEN adds THEN all_sum WHEN r THEN q END, 3) AS cumulative_value,
  round(CASE WHEN unit_is_flag OR (adds AND data_source = 'official') THEN value WHEN adds AND project = '{NEW}' THEN new_sum WHEN r THEN q END, 3) AS cumulative_value_{NEW},
  data_source <> 'official' AND coalesce(m.note ILIKE '%indicateur changé%' OR m.note ILIKE '%indicateur supprimé%', false) AS indicator_changed
FROM (SELECT *, unit = 'boolean' AS unit_is_flag FROM shares) s JOIN meta m ON m.code_v2 = s.code
"""


def official_figures(spark, sf):
    meta = fixed_table(spark, _META, "code string, code_v2 string, indicator_name string, unit string, note string").select("code", "indicator_name", "unit")
    counted = table(spark, sf, "orders").groupBy(
        F.expr(_OFFICIAL).alias("indicator_code"), (F.year("o_orderdate") + 24).alias("year"), F.col("o_orderpriority").alias("country")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return counted.join(meta, F.col("indicator_code") == F.col("code")).drop("code").withColumns(
        {"level": F.lit(2), "project": F.lit(NEW), "indicator_changed": F.lit(False), "date": F.lit(None).cast("string")}
    )


@query("indicator_table", JOB_SQL)
def whole_job(spark, sf):
    meta = fixed_table(spark, _META, "code string, code_v2 string, designation_v2 string, unite_v2 string, note string")
    published = indicator_table(
        every_table(spark, sf), history_facts(history_view(spark, sf), OLD), meta, official_figures(spark, sf), Projects(OLD, NEW)
    )
    # without any denominator a quotient is not a number; the report takes it as null
    shown = ("numerator", "denominator", "value", "cumulative_numerator", "cumulative_denominator", "cumulative_value", f"cumulative_value_{NEW}")
    return published.withColumns({c: F.round(nan_to_null(F.col(c)), 3) for c in shown})
