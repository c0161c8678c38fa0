"""Sites to regions, countries and the top.  Site: supplier; region: nation; country: region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmark.operators.rollup import aggregate, rollup
from fieldmark.schema import VALUE, align

from .registry import query, table


def places(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", F.col("r_name").alias("country"), F.col("n_name").alias("region")
    )


def site_facts(spark: SparkSession, sf: str, kinds: tuple[str, ...] = ("Q", "S", "T", "F", "U")) -> DataFrame:
    """Level-6 facts of every supplier, return flag and year, several indicators each.

    Line items are summed per supplier before anything is joined, so the join
    moves one row per supplier, flag and year.
    """
    qty = F.col("l_quantity")
    totals = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_returnflag", F.year("l_shipdate").alias("date"))
        .agg(
            F.sum(qty).alias("qty"),
            F.sum(F.when(F.col("l_linestatus") == "O", qty).otherwise(0.0)).alias("open_qty"),
        )
    )
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    sited = totals.join(supplier, totals["l_suppkey"] == supplier["s_suppkey"])
    where = places(spark, sf)
    sited = sited.join(where, sited["s_nationkey"] == where["n_nationkey"])
    none = F.lit(None).cast("double")

    def entry(kind, unit, numerator, denominator, value):
        return F.struct(
            F.concat(F.lit(f"{kind}-"), "l_returnflag").alias("indicator_code"),
            F.lit(unit).alias("unit"),
            numerator.alias("numerator"),
            denominator.alias("denominator"),
            value.alias("value"),
        )

    made = {
        "Q": entry("Q", "count", none, none, F.col("qty")),
        "S": entry("S", "percent", F.col("open_qty"), F.col("qty"), none),
        "T": entry("T", "percent", none, none, F.col("qty")),
        "F": entry("F", "boolean", none, none, F.when(F.col("open_qty") > 100, 1.0).otherwise(0.0)),
        "U": entry("U", "other", none, none, F.col("qty")),
    }
    facts = sited.withColumn("e", F.explode(F.array(*[made[k] for k in kinds])))
    facts = facts.select("e.*", "date", "country", "region").withColumns(
        {
            "indicator_name": F.col("indicator_code"),
            "project": F.lit("p"),
            "level": F.lit(6),
            "indicator_changed": F.lit(False),
        }
    )
    return align(facts, VALUE)


OUT = ["indicator_code", "unit", "date", "level", "country", "region", "numerator", "denominator"]


def shown(df: DataFrame) -> DataFrame:
    return df.select(*OUT, F.round("value", 6).alias("value"))


# --- the same in SQL ---------------------------------------------------------

SITES_SQL = """
site AS (
  SELECT l_suppkey, l_returnflag AS flag, CAST(year(l_shipdate) AS INTEGER) AS date, r_name AS country, n_name AS region,
         sum(l_quantity) AS qty,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS open_qty
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL),
facts AS (
  SELECT 'Q-' || flag AS code, 'count' AS unit, date, country, region,
         CAST(NULL AS DOUBLE) AS num, CAST(NULL AS DOUBLE) AS den, qty AS value FROM site
  UNION ALL SELECT 'S-' || flag, 'percent', date, country, region, open_qty, qty, NULL FROM site
  UNION ALL SELECT 'T-' || flag, 'percent', date, country, region, NULL, NULL, qty FROM site
  UNION ALL SELECT 'F-' || flag, 'boolean', date, country, region, NULL, NULL,
         CASE WHEN open_qty > 100 THEN 1.0 ELSE 0.0 END FROM site)
"""


def step_sql(source: str, country: str, region: str, stage: int, level: int) -> str:
    """One rollup step: four plain aggregations of the rows in ``source``."""
    by = f"code, unit, date, {country}, {region}"
    head = f"SELECT code, unit, date, {country} AS country, {region} AS region"
    where = {
        "sum": "unit IN ('count', 'weight', 'surface')",
        "ratio": "unit = 'percent' AND num IS NOT NULL AND den IS NOT NULL",
        "mean": "unit = 'percent' AND (num IS NULL OR den IS NULL)",
        "all": "unit = 'boolean'",
    }
    none = "CAST(NULL AS DOUBLE)"
    what = {
        "sum": f"{none} AS num, {none} AS den, coalesce(sum(value), 0) AS value",
        "ratio": "sum(num) AS num, sum(den) AS den, sum(num) / sum(den) AS value",
        "mean": f"{none} AS num, {none} AS den, avg(value) AS value",
        "all": f"{none} AS num, {none} AS den, CAST(coalesce(min(value), 1) <> 0 AS INTEGER)::DOUBLE AS value",
    }
    parts = [
        f"{head}, {what[k]}, {level} AS level, {stage} AS stage, {i} AS kind FROM {source} WHERE {where[k]} GROUP BY {by}"
        for i, k in enumerate(where)
    ]
    return "\nUNION ALL ".join(parts)


def rollup_sql(reported: str | None = None) -> str:
    """CTEs from ``facts`` (and reported rows of levels 1 to 3) to ``rolled``."""
    none = "CAST(NULL AS VARCHAR)"
    base = (
        f"SELECT code, unit, date, country, region, num, den, value, level, 0 AS stage, 0 AS kind FROM {reported}"
        if reported
        else "SELECT *, 3 AS level, 0 AS stage, 0 AS kind FROM facts WHERE false"
    )
    return f"""
base AS ({base}),
l3 AS ({step_sql('facts', 'country', 'region', 1, 3)}),
in2 AS (SELECT * FROM base WHERE level = 3 UNION ALL BY NAME SELECT * FROM l3),
l2 AS ({step_sql('in2', 'country', none, 2, 2)}),
in1 AS (SELECT * FROM base WHERE level = 2 UNION ALL BY NAME SELECT * FROM l2),
l1 AS ({step_sql('in1', "'Régional'", none, 3, 1)}),
every AS (SELECT * FROM base UNION ALL BY NAME SELECT * FROM l3 UNION ALL BY NAME SELECT * FROM l2 UNION ALL BY NAME SELECT * FROM l1),
rolled AS (
  SELECT code AS indicator_code, unit, date, level, country, region, num AS numerator, den AS denominator, value
  FROM (SELECT *, row_number() OVER (PARTITION BY code, date, level, country, region ORDER BY stage, kind) AS rn FROM every)
  WHERE rn = 1)
"""


SHOWN_SQL = """
SELECT indicator_code, unit, date, level, country, region, numerator, denominator, round(value, 6) AS value FROM rolled
"""

ROLLUP_ALL_SQL = f"WITH {SITES_SQL}, {rollup_sql()} {SHOWN_SQL}"


@query("rollup_hierarchy", ROLLUP_ALL_SQL)
def rollup_hierarchy(spark, sf):
    return shown(rollup(site_facts(spark, sf)))


def _one_kind(name: str, letter: str) -> None:
    @query(name, f"{ROLLUP_ALL_SQL} WHERE indicator_code LIKE '{letter}-%'")
    def run(spark, sf):
        return shown(rollup(site_facts(spark, sf, (letter,))))


for _name, _letter in (("rollup_sum", "Q"), ("rollup_ratio", "S"), ("rollup_mean", "T"), ("rollup_all", "F")):
    _one_kind(_name, _letter)


def reported_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Country rows reported directly: orders of each country and year, for one code."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_customer = orders.groupBy("o_custkey", F.year("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    where = places(spark, sf)
    counted = (
        per_customer.join(customer, per_customer["o_custkey"] == customer["c_custkey"])
        .join(where, F.col("c_nationkey") == where["n_nationkey"])
        .groupBy("country", "date")
        .agg(F.sum("n").cast("double").alias("value"))
    )
    reported = counted.withColumns(
        {
            "indicator_code": F.lit("Q-R"),
            "indicator_name": F.lit("Q-R"),
            "unit": F.lit("count"),
            "project": F.lit("p"),
            "level": F.lit(2),
            "indicator_changed": F.lit(False),
        }
    )
    return align(reported, VALUE)


REPORTED_SQL = """
reported AS (
  SELECT 'Q-R' AS code, 'count' AS unit, CAST(year(o_orderdate) AS INTEGER) AS date, r_name AS country, CAST(NULL AS VARCHAR) AS region,
         CAST(NULL AS DOUBLE) AS num, CAST(NULL AS DOUBLE) AS den, CAST(count(*) AS DOUBLE) AS value, 2 AS level
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)
"""


@query("reported_beats_rolled", f"WITH {SITES_SQL}, {REPORTED_SQL}, {rollup_sql('reported')} {SHOWN_SQL}")
def reported_beats_rolled(spark, sf):
    facts = site_facts(spark, sf, ("Q", "S", "T", "F")).unionByName(reported_rows(spark, sf))
    return shown(rollup(facts))


_ONCE_SQL = f"""
WITH {SITES_SQL}, {REPORTED_SQL},
{rollup_sql('reported').replace(
    "in1 AS (SELECT * FROM base WHERE level = 2 UNION ALL BY NAME SELECT * FROM l2)",
    "in1 AS (SELECT * FROM base WHERE level = 2 UNION ALL BY NAME SELECT * FROM l2 WHERE NOT EXISTS "
    "(SELECT 1 FROM base b WHERE b.code = l2.code AND b.date = l2.date AND b.country = l2.country))",
)} {SHOWN_SQL}"""


@query("rollup_without_double_count", _ONCE_SQL)
def rollup_without_double_count(spark, sf):
    facts = site_facts(spark, sf, ("Q", "S", "T", "F")).unionByName(reported_rows(spark, sf))
    return shown(rollup(facts, dedup_each_level=True))


_REPORTED = "SELECT 'I-' || l_returnflag AS indicator_code, year(l_shipdate) AS date, l_quantity AS value, l_linenumber % 2 AS src_rank, l_orderkey * 10 + l_linenumber AS src_line FROM lineitem"


@query(
    "reported_first_row",
    f"""SELECT indicator_code, CAST(date AS INTEGER) AS date, CAST(value AS DOUBLE) AS value FROM (
        SELECT *, row_number() OVER (PARTITION BY indicator_code, date ORDER BY src_rank, src_line) AS n FROM ({_REPORTED})) WHERE n = 1""",
)
def reported_first_row(spark, sf):
    """Of several reports by the same place and year the first by source, then submission, counts."""
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("I-"), "l_returnflag").alias("indicator_code"),
        F.lit("count").alias("unit"),
        F.year("l_shipdate").alias("date"),
        F.lit(1).alias("level"),
        F.lit("Régional").alias("country"),
        F.col("l_quantity").cast("double").alias("value"),
        (F.col("l_linenumber") % 2).cast("int").alias("src_rank"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("src_line"),
    )
    absent = {f.name: F.lit(None).cast(f.dataType) for f in VALUE.fields if f.name not in rows.columns}
    return rollup(rows.withColumns(absent)).select("indicator_code", "date", "value")


# --- fractions -----------------------------------------------------------------

#: fractions of 53 bits as whole numbers of 2^-60, which add without error
_UNIT = "1152921504606846976"
_PARTS = {"value": "l_extendedprice * (1 - l_discount)", "numerator": "l_extendedprice * l_tax", "denominator": "l_extendedprice / 3"}


def _exact_sql(column: str) -> str:
    return f"CAST(sum(CAST({column} * {_UNIT} AS HUGEINT)) AS DOUBLE) / {_UNIT}"


@query(
    "aggregate_fractions",
    f"""WITH l AS (SELECT l_returnflag AS indicator_code, {", ".join(f"{how} AS {name}" for name, how in _PARTS.items())}, l_suppkey,
              CASE l_linestatus WHEN 'O' THEN 'count' ELSE 'percent' END AS unit, l_linenumber % 2 = 0 AS bare FROM lineitem),
    g AS (SELECT l_suppkey, indicator_code, CASE WHEN unit = 'count' THEN 'sum' WHEN bare THEN 'mean' ELSE 'ratio' END AS kind,
              {_exact_sql("value")} AS v, count(*) AS n, {_exact_sql("numerator")} AS p, {_exact_sql("denominator")} AS q FROM l GROUP BY ALL)
    SELECT l_suppkey, indicator_code, kind, CASE WHEN kind = 'ratio' THEN p END AS numerator, CASE WHEN kind = 'ratio' THEN q END AS denominator,
           CASE kind WHEN 'sum' THEN v WHEN 'mean' THEN v / n ELSE p / q END AS value FROM g""",
)
def aggregate_fractions(spark, sf):
    """Sums, means and ratios of fractions per supplier and flag, equal to the last bit."""
    with_terms = (F.col("l_linestatus") == "O") | (F.col("l_linenumber") % 2 == 1)
    lines = table(spark, sf, "lineitem").select(
        "l_suppkey",
        F.col("l_returnflag").alias("indicator_code"),
        F.when(F.col("l_linestatus") == "O", "count").otherwise("percent").alias("unit"),
        F.expr(_PARTS["value"]).alias("value"),
        *[F.when(with_terms, F.expr(_PARTS[c])).alias(c) for c in ("numerator", "denominator")],
    )
    return aggregate(lines, ["l_suppkey", "indicator_code"])
