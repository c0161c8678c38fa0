"""From rolled-up values to the published table: gap fill, override, cumulation, report."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmark.functions.numeric import nan_to_null
from fieldmark.operators.cumulate import cumulate_counts, cumulate_flags, cumulate_ratios
from fieldmark.operators.gapfill import gap_fill
from fieldmark.operators.ordered import block_of_time, running_sum
from fieldmark.operators.override import override
from fieldmark.operators.rollup import rollup
from fieldmark.plans.indicators import Projects, complete_values, table_counts
from fieldmark.schema import VALUE, align
from fieldmark.session import settle

from .registry import query, table
from .rollups import SITES_SQL, places, rollup_sql, site_facts

OLD, NEW = "old", "new"
FIRST, LAST_OLD = 1993, 1996
PROJECTS = Projects(OLD, NEW)

_PROJECT_SQL = f"CASE WHEN date <= {LAST_OLD} THEN '{OLD}' ELSE '{NEW}' END"


# --- gap fill ------------------------------------------------------------------


def order_facts(spark, sf):
    """Level-6 facts of every customer and year; codes fine enough to leave gaps."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    per_customer = table(spark, sf, "orders").groupBy(
        "o_custkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("date")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))
    where = places(spark, sf)
    facts = (
        per_customer.join(customer, per_customer["o_custkey"] == customer["c_custkey"])
        .join(where, F.col("c_nationkey") == where["n_nationkey"])
        .withColumn("indicator_code", F.concat_ws("/", "o_orderpriority", "o_orderstatus", "c_mktsegment"))
        .withColumns(
            {
                "indicator_name": F.concat(F.lit("name of "), "indicator_code"),
                "unit": F.lit("count"),
                "project": F.when(F.col("date") <= LAST_OLD, OLD).otherwise(NEW),
                "level": F.lit(6),
                "indicator_changed": F.lit(False),
            }
        )
    )
    return align(facts, VALUE)


ORDER_FACTS_SQL = """
facts AS (
  SELECT o_orderpriority || '/' || o_orderstatus || '/' || c_mktsegment AS code, 'count' AS unit,
         CAST(year(o_orderdate) AS INTEGER) AS date, r_name AS country, n_name AS region,
         CAST(NULL AS DOUBLE) AS num, CAST(NULL AS DOUBLE) AS den, CAST(count(*) AS DOUBLE) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)
"""

GAPS_SQL = f"""
codes AS (SELECT indicator_code, min(unit) AS unit, max(level) AS deepest FROM rolled GROUP BY 1),
countries AS (SELECT DISTINCT country FROM rolled WHERE level = 2),
years AS (SELECT CAST(unnest(generate_series({FIRST}, (SELECT max(date) FROM rolled))) AS INTEGER) AS date),
spine AS (
  SELECT indicator_code, unit, date, 1 AS level, 'Régional' AS country, CAST(NULL AS VARCHAR) AS region FROM codes, years
  UNION ALL SELECT indicator_code, unit, date, 2, country, NULL FROM codes, years, countries WHERE deepest >= 2
  UNION ALL SELECT indicator_code, unit, date, 3, country, region
  FROM (SELECT DISTINCT r.indicator_code, c.unit, r.country, r.region
        FROM rolled r JOIN codes c USING (indicator_code)
        WHERE c.deepest >= 3 AND r.region <> '' AND r.country IN (SELECT country FROM countries)), years),
filled AS (
  SELECT indicator_code, unit, date, level, country, region, numerator, denominator, value FROM rolled
  UNION ALL
  SELECT s.*, NULL, NULL, NULL FROM spine s
  WHERE NOT EXISTS (SELECT 1 FROM rolled r WHERE r.indicator_code = s.indicator_code AND r.date = s.date
                    AND r.country IS NOT DISTINCT FROM s.country AND r.region IS NOT DISTINCT FROM s.region))
"""


@query(
    "gap_fill_spine",
    f"""WITH {ORDER_FACTS_SQL}, {rollup_sql()}, {GAPS_SQL}
    SELECT indicator_code, 'name of ' || indicator_code AS indicator_name, unit, date, {_PROJECT_SQL} AS project,
           level, country, region, value FROM filled""",
)
def gap_fill_spine(spark, sf):
    rolled = settle(rollup(order_facts(spark, sf)))
    return gap_fill(rolled, OLD, NEW, FIRST, LAST_OLD).drop("numerator", "denominator", "indicator_changed")


# --- override ------------------------------------------------------------------


def by_place(spark, sf, condition):
    """Orders per priority, year and country, in the value schema."""
    orders = table(spark, sf, "orders").filter(condition)
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    where = places(spark, sf)
    per_customer = orders.groupBy(
        "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("date")
    ).agg(F.count(F.lit(1)).alias("n"))
    counted = (
        per_customer.join(customer, per_customer["o_custkey"] == customer["c_custkey"])
        .join(where, F.col("c_nationkey") == where["n_nationkey"])
        .groupBy(F.col("o_orderpriority").alias("indicator_code"), "date", "country")
        .agg(F.sum("n").cast("double").alias("value"))
    )
    return align(
        counted.withColumns(
            {
                "indicator_name": F.col("indicator_code"),
                "unit": F.lit("count"),
                "level": F.lit(2),
                "project": F.when(F.col("date") <= LAST_OLD, OLD).otherwise(NEW),
                "indicator_changed": F.lit(False),
            }
        ),
        VALUE,
    )


#: official figures: urgent orders from one year on, high ones from the year before
OFFICIAL = """(o_orderpriority = '1-URGENT' AND o_orderdate >= DATE '2000-01-01')
    OR (o_orderpriority = '2-HIGH' AND o_orderdate >= DATE '1999-01-01')"""


def _by_place_sql(condition: str) -> str:
    return f"""
    SELECT o_orderpriority AS indicator_code, CAST(year(o_orderdate) AS INTEGER) AS date, r_name AS country,
           CAST(count(*) AS DOUBLE) AS value
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE {condition} GROUP BY ALL"""


OVERRIDE_INPUT_SQL = f"""
computed AS ({_by_place_sql("true")}),
official AS ({_by_place_sql(OFFICIAL)})
"""

INDEPENDENT_SQL = """
merged AS (
  SELECT *, 'survey' AS data_source FROM computed
  WHERE NOT (indicator_code IN (SELECT indicator_code FROM official) AND date IN (SELECT date FROM official)
             AND country IN (SELECT country FROM official))
  UNION ALL SELECT *, 'official' FROM official)
"""


def _merged(spark, sf, match="independent"):
    # read once for its rows and once for each of its sets
    official = settle(by_place(spark, sf, OFFICIAL))
    return override(by_place(spark, sf, "true"), official, match)


_OVERRIDE_OUT = ["indicator_code", "date", "country", "value", "data_source"]


@query("override_independent", f"WITH {OVERRIDE_INPUT_SQL}, {INDEPENDENT_SQL} SELECT * FROM merged")
def override_independent(spark, sf):
    return _merged(spark, sf).select(*_OVERRIDE_OUT)


@query(
    "override_by_tuple",
    f"""WITH {OVERRIDE_INPUT_SQL}
    SELECT c.*, 'survey' AS data_source FROM computed c ANTI JOIN official o
           ON c.indicator_code = o.indicator_code AND c.date = o.date AND c.country = o.country
    UNION ALL SELECT *, 'official' FROM official""",
)
def override_by_tuple(spark, sf):
    return _merged(spark, sf, "tuple").select(*_OVERRIDE_OUT)


# --- cumulation ----------------------------------------------------------------

_COUNTS_SQL = f"""
SELECT indicator_code, date, country, value, data_source,
       CASE WHEN data_source = 'official' THEN value ELSE sum(value) OVER w END AS cumulated_value,
       CASE WHEN data_source = 'official' THEN value WHEN date <= {LAST_OLD} THEN NULL
            ELSE sum(CASE WHEN date > {LAST_OLD} THEN value ELSE 0 END) OVER w END AS cumulated_value_current
FROM merged
WINDOW w AS (PARTITION BY indicator_code, country ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


@query("cumulate_counts", f"WITH {OVERRIDE_INPUT_SQL}, {INDEPENDENT_SQL} {_COUNTS_SQL}")
def cumulate_counts_by_source(spark, sf):
    merged = settle(_merged(spark, sf))
    return cumulate_counts(merged, OLD, NEW).select(
        *_OVERRIDE_OUT, "cumulated_value", "cumulated_value_current"
    )


def _dated_sites(spark, sf, kinds):
    facts = site_facts(spark, sf, kinds)
    return facts.withColumn("project", F.when(F.col("date") <= LAST_OLD, OLD).otherwise(NEW))


def _cumulable(spark, sf, kinds):
    return settle(rollup(settle(_dated_sites(spark, sf, kinds)))).withColumn("data_source", F.lit("survey"))


_RATIO_OUT = ["indicator_code", "date", "level", "country", "region"]


@query(
    "cumulate_ratios",
    f"""WITH {SITES_SQL}, {rollup_sql()}, s AS (SELECT * FROM rolled WHERE unit = 'percent' AND indicator_code LIKE 'S-%'),
    c AS (SELECT *, sum(numerator) OVER w AS n, sum(denominator) OVER w AS d FROM s WHERE date > {LAST_OLD}
          WINDOW w AS (PARTITION BY level, indicator_code, country, region ORDER BY date
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT indicator_code, date, level, country, region, n AS cumulated_numerator, d AS cumulated_denominator,
           n / d AS cumulated_value, n / d AS cumulated_value_current FROM c
    UNION ALL SELECT indicator_code, date, level, country, region, NULL, NULL, NULL, NULL FROM s WHERE date <= {LAST_OLD}""",
)
def cumulate_ratios_by_place(spark, sf):
    return cumulate_ratios(_cumulable(spark, sf, ("S",)), OLD, NEW).select(
        *_RATIO_OUT, "cumulated_numerator", "cumulated_denominator", "cumulated_value", "cumulated_value_current"
    )


@query(
    "cumulate_flags",
    f"""WITH {SITES_SQL}, {rollup_sql()}
    SELECT indicator_code, date, level, country, region, value AS cumulated_value, value AS cumulated_value_current
    FROM rolled WHERE unit = 'boolean'""",
)
def cumulate_flags_by_place(spark, sf):
    return cumulate_flags(_cumulable(spark, sf, ("F",)), OLD, NEW).select(
        *_RATIO_OUT, "cumulated_value", "cumulated_value_current"
    )


@query(
    "period_split_running_sum",
    f"""SELECT o_orderkey, o_custkey,
        sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER w ::BIGINT AS all_cents,
        sum(CASE WHEN year(o_orderdate) > {LAST_OLD} THEN CAST(round(o_totalprice * 100) AS BIGINT) ELSE 0 END) OVER w ::BIGINT AS new_cents
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def period_split_running_sum(spark, sf):
    """Running sums per customer over all orders and over those of the current project.

    Blocks are days, so a customer with any share of the orders is spread.
    """
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", cents.alias("cents"))
    sums = {
        "all_cents": F.col("cents"),
        "new_cents": F.when(F.year("o_orderdate") > LAST_OLD, F.col("cents")),
    }
    summed = running_sum(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], sums, [block_of_time(F.col("o_orderdate"), 86400)])
    return summed.select("o_orderkey", "o_custkey", "all_cents", "new_cents")


# --- the whole ---------------------------------------------------------------


def flow(spark, sf):
    rolled = settle(rollup(settle(_dated_sites(spark, sf, ("Q", "S", "F")))))
    official = by_place(spark, sf, "o_orderdate >= DATE '1999-01-01'")
    official = official.withColumn(
        "indicator_code", F.when(F.col("indicator_code").isin("1-URGENT", "2-HIGH"), "Q-A").otherwise("S-N")
    )
    figures = official.groupBy("indicator_code", F.col("date").alias("year"), "country").agg(F.sum("value").alias("value"))
    figures = figures.withColumns(
        {
            "indicator_name": F.col("indicator_code"),
            "unit": F.when(F.col("indicator_code") == "Q-A", "count").otherwise("percent"),
            "level": F.lit(2),
            "project": F.lit(NEW),
            "indicator_changed": F.lit(False),
        }
    )
    return complete_values(rolled, settle(figures), PROJECTS, FIRST, LAST_OLD)


FLOW_SQL = f"""
WITH {SITES_SQL}, {rollup_sql()}, {GAPS_SQL},
official AS (
  SELECT indicator_code, CASE WHEN indicator_code = 'Q-A' THEN 'count' ELSE 'percent' END AS unit, date, 2 AS level, country, sum(n) AS value
  FROM (SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Q-A' ELSE 'S-N' END AS indicator_code,
               CAST(year(o_orderdate) AS INTEGER) AS date, r_name AS country, CAST(count(*) AS DOUBLE) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        WHERE o_orderdate >= DATE '1999-01-01' GROUP BY ALL)
  GROUP BY ALL),
merged AS (
  SELECT indicator_code, unit, date, level, country, region, numerator, denominator, value,
         {_PROJECT_SQL} AS project, 'survey' AS data_source
  FROM filled WHERE unit <> 'percent' OR indicator_code LIKE 'S-%'
  UNION ALL
  SELECT indicator_code, unit, date, level, country, NULL, NULL, NULL, value, '{NEW}', 'official' FROM official),
kept AS (
  SELECT * FROM merged WHERE data_source = 'official'
     OR NOT coalesce(indicator_code IN (SELECT indicator_code FROM official) AND date IN (SELECT date FROM official)
                     AND country IN (SELECT country FROM official), false)),
summed AS (
  SELECT *,
    sum(coalesce(value, 0)) OVER w AS all_sum,
    sum(CASE WHEN project = '{NEW}' THEN coalesce(value, 0) ELSE 0 END) OVER w AS new_sum,
    sum(CASE WHEN project = '{NEW}' THEN coalesce(numerator, 0) ELSE 0 END) OVER w AS n,
    sum(CASE WHEN project = '{NEW}' THEN coalesce(denominator, 0) ELSE 0 END) OVER w AS d
  FROM kept
  WINDOW w AS (PARTITION BY unit, level, indicator_code, country, region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
shares AS (
  SELECT *, unit = 'percent' AND project = '{NEW}' AS r,
         CASE WHEN d <> 0 THEN n / d END AS q FROM summed WHERE unit <> 'other')
SELECT indicator_code, indicator_code AS indicator_name, unit, date AS year, date || '-01-01' AS date, project, level, country, region,
       numerator, denominator, value,
       CASE WHEN r THEN n END AS cumulative_numerator, CASE WHEN r THEN d END AS cumulative_denominator,
       CASE WHEN unit = 'boolean' OR (unit = 'count' AND data_source = 'official') THEN value
            WHEN unit = 'count' THEN all_sum WHEN r THEN q END AS cumulative_value,
       CASE WHEN unit = 'boolean' OR (unit = 'count' AND data_source = 'official') THEN value
            WHEN unit = 'count' AND project = '{NEW}' THEN new_sum WHEN r THEN q END AS cumulative_value_new,
       false AS indicator_changed
FROM shares
"""

# the flow has no unweighted percentages and no unit without a rule
FLOW_SQL = FLOW_SQL.replace(SITES_SQL, SITES_SQL.replace("UNION ALL SELECT 'T-' || flag, 'percent', date, country, region, NULL, NULL, qty FROM site", ""))


@query("indicator_flow", FLOW_SQL)
def indicator_flow(spark, sf):
    out = flow(spark, sf)
    # without any denominator the quotient is not a number; the report takes it as null
    return out.withColumns({c: nan_to_null(F.col(c)) for c in ("cumulative_value", "cumulative_value_new")})


@query("indicator_counts", f"WITH f AS ({FLOW_SQL}) SELECT count(*) AS n_rows, count(DISTINCT indicator_code) AS n_codes FROM f")
def indicator_counts(spark, sf):
    return table_counts(flow(spark, sf))
