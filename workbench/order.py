"""Rows in order, one row per key, wide and long."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmark.operators.dedup import PLACE, keep_first, keep_lone_or_marked, latest_per_key, with_places, yearly_snapshots
from fieldmark.operators.lookups import duplicate_keys
from fieldmark.operators.ordered import block_of_time, change_counter, forward_fill, previous_value, row_index, running_sum
from fieldmark.operators.reshape import pivot_years, unpivot_ordered, year_in_name
from fieldmark.operators.resolve import number_sub_items
from fieldmark.plans.framework import block_min_order

from .registry import query, table


def events(spark, sf):
    return table(spark, sf, "events")


def _gappy(spark, sf):
    """Events whose value is missing unless they are purchases."""
    value = F.when(F.col("event_type") == "purchase", F.col("value"))
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    return events(spark, sf).select("event_id", "user_id", "ts", value.alias("value"), kind.alias("kind"))


_GAPPY_SQL = """
gappy AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'purchase' THEN value END AS value,
                 CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events)
"""


@query(
    "forward_fill",
    f"""WITH {_GAPPY_SQL} SELECT event_id, user_id, last_value(value IGNORE NULLS) OVER w AS value,
        last_value(kind IGNORE NULLS) OVER w AS kind FROM gappy
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def forward_fill_per_user(spark, sf):
    filled = forward_fill(
        _gappy(spark, sf), ["user_id"], ["ts", "event_id"], ["value", "kind"], [block_of_time(F.col("ts"), 3600)]
    )
    return filled.select("event_id", "user_id", "value", "kind")


@query(
    "forward_fill_whole_table",
    f"""WITH {_GAPPY_SQL} SELECT event_id, last_value(value IGNORE NULLS) OVER w AS value FROM gappy
        WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def forward_fill_whole(spark, sf):
    """No key at all: the minutes of the table are filled side by side."""
    filled = forward_fill(_gappy(spark, sf), [], ["ts", "event_id"], ["value"], [block_of_time(F.col("ts"), 60)])
    return filled.select("event_id", "value")


@query(
    "row_index",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events""",
)
def position_in_user(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts")
    return row_index(rows, ["user_id"], ["ts", "event_id"], "pos", [block_of_time(F.col("ts"), 3600)]).drop("ts")


#: a fraction of 53 bits, as a whole number of 2^-60
_CHARGE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"
_EXACT = "CAST(sum(CAST(charge * 1152921504606846976 AS HUGEINT)) {over} AS DOUBLE) / 1152921504606846976"


@query(
    "running_sum_fractions",
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, {_CHARGE} AS charge FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_suppkey, {_EXACT.format(over="OVER w")} AS charged FROM l
        WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_sum_fractions(spark, sf):
    """Running sums of fractions per supplier, exact to the last bit; blocks are quarters of 91 days."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    lines = table(spark, sf, "lineitem").select("l_suppkey", *order, F.expr(_CHARGE).alias("charge"))
    summed = running_sum(lines, ["l_suppkey"], order, {"charged": F.col("charge")}, [block_of_time(F.col("l_shipdate"), 91 * 86400)])
    return summed.select("l_orderkey", "l_linenumber", "l_suppkey", "charged")


@query(
    "previous_row",
    "SELECT event_id, lag(event_type) OVER (ORDER BY ts, event_id) AS before FROM events",
)
def previous_row(spark, sf):
    rows = events(spark, sf).select("event_id", "ts", "event_type")
    stepped = previous_value(rows, [], ["ts", "event_id"], {"before": "event_type"}, [block_of_time(F.col("ts"), 60)])
    return stepped.select("event_id", "before")


@query(
    "block_min_order",
    """SELECT event_id, min(event_id) OVER (PARTITION BY user_id, event_type, event_id // 100) AS first_id FROM events""",
)
def block_min(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "event_type")
    return block_min_order(rows, ["user_id", "event_type"], "event_id", "first_id").select("event_id", "first_id")


@query(
    "change_counter",
    """WITH s AS (SELECT event_id, user_id, ts, event_type, CAST(value > 20 AS INTEGER) AS big,
                         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
       SELECT event_id, sum(CASE WHEN event_type <> before THEN 1 ELSE 0 END) OVER
              (PARTITION BY user_id, big ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS n_changes
       FROM s""",
)
def changes_per_user(spark, sf):
    rows = events(spark, sf).select(
        "event_id", "user_id", "ts", "event_type", (F.col("value") > 20).cast("int").alias("big")
    )
    counted = change_counter(
        rows, ["user_id"], ["big"], ["ts", "event_id"], "event_type", "n_changes", [block_of_time(F.col("ts"), 3600)]
    )
    return counted.select("event_id", "n_changes")


@query(
    "parent_child_codes",
    """WITH n AS (SELECT event_id, user_id,
              CASE WHEN event_type IN ('purchase', 'signup') THEN event_type ELSE 'dont ' || event_type END AS clean,
              CASE WHEN event_type = 'purchase' THEN 'P' || CAST(event_id % 10 AS VARCHAR) END AS code_ref FROM events),
       f AS (SELECT *, starts_with(clean, 'dont ') AS sub,
              last_value(CASE WHEN NOT starts_with(clean, 'dont ') THEN code_ref END IGNORE NULLS) OVER w AS parent,
              lag(clean) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM n
              WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
       c AS (SELECT *, sum(CASE WHEN sub AND clean <> before THEN 1 ELSE 0 END) OVER
              (PARTITION BY user_id, parent ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS suffix FROM f)
       SELECT event_id, user_id, clean, CASE WHEN NOT sub THEN code_ref ELSE parent || CAST(suffix AS VARCHAR) END AS code_final FROM c""",
)
def parent_child_codes(spark, sf):
    kind = F.col("event_type")
    names = events(spark, sf).select(
        "event_id",
        "user_id",
        F.when(kind.isin("purchase", "signup"), kind).otherwise(F.concat(F.lit("dont "), kind)).alias("clean"),
        F.when(kind == "purchase", F.concat(F.lit("P"), (F.col("event_id") % 10).cast("string"))).alias("code_ref"),
    )
    return number_sub_items(names, ["user_id"], "event_id").select("event_id", "user_id", "clean", "code_final")


# --- one row per key -------------------------------------------------------------


@query(
    "keep_first",
    """SELECT l_orderkey, l_partkey, l_quantity FROM (SELECT *, row_number() OVER
       (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def first_line_of_order(spark, sf):
    lines = with_places(table(spark, sf, "lineitem"))
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return keep_first(lines, ["l_orderkey"], [F.col(c) for c in order], PLACE).select("l_orderkey", "l_partkey", "l_quantity")


def _dated_orders(spark, sf):
    """Orders, pending ones without a date."""
    day = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", day.alias("day"))


_DATED_SQL = """
dated AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day FROM orders)
"""


@query(
    "latest_per_key",
    f"""WITH {_DATED_SQL} SELECT o_custkey, o_orderkey, day, o_totalprice FROM (SELECT *, row_number() OVER
        (PARTITION BY o_custkey ORDER BY day DESC NULLS FIRST, o_orderkey DESC) AS rn FROM dated) WHERE rn = 1""",
)
def latest_order(spark, sf):
    latest = latest_per_key(_dated_orders(spark, sf), ["o_custkey"], "day", ["o_orderkey"], place=["o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "day", "o_totalprice")


@query(
    "latest_dated_per_key",
    f"""WITH {_DATED_SQL} SELECT o_custkey, o_orderkey, day FROM (SELECT *, row_number() OVER
        (PARTITION BY o_custkey ORDER BY day DESC NULLS LAST, o_orderkey DESC) AS rn FROM dated) WHERE rn = 1""",
)
def latest_dated_order(spark, sf):
    latest = latest_per_key(_dated_orders(spark, sf), ["o_custkey"], "day", ["o_orderkey"], nulls="last", place=["o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "day")


@query(
    "yearly_snapshots",
    f"""WITH {_DATED_SQL}, years AS (SELECT unnest(generate_series((SELECT min(year(day)) FROM dated), (SELECT max(year(day)) FROM dated))) AS y)
        SELECT o_custkey, CAST(y AS INTEGER) AS over_year, o_orderkey, day FROM (SELECT *, row_number() OVER
        (PARTITION BY o_custkey, y ORDER BY day DESC, o_orderkey DESC) AS rn FROM dated JOIN years ON year(day) <= y) WHERE rn = 1""",
)
def order_snapshots(spark, sf):
    snapshots = yearly_snapshots(_dated_orders(spark, sf), "o_custkey", "day", ["o_orderkey"], place=["o_orderkey"])
    return snapshots.select("o_custkey", "over_year", "o_orderkey", "day")


@query(
    "keep_restructured_variant",
    """WITH p AS (SELECT *, p_brand || CASE WHEN p_retailprice >= 990 THEN ' restruc' ELSE '' END AS country FROM part),
       c AS (SELECT *, count(*) OVER (PARTITION BY p_name, p_type, p_brand) AS n FROM p)
       SELECT p_partkey, country FROM c WHERE n = 1 OR contains(country, 'restruc')""",
)
def restructured_variant(spark, sf):
    mark = F.when(F.col("p_retailprice") >= 990, " restruc").otherwise("")
    parts = table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_type", "p_brand", F.concat("p_brand", mark).alias("country")
    )
    kept = keep_lone_or_marked(parts, ["p_name", "p_type", "p_brand"], F.col("country").contains("restruc"))
    return kept.select("p_partkey", "country")


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_lines(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- wide and long -----------------------------------------------------------------

_MEASURES = {"target_value_2021": "l_quantity", "target_value_2024": "l_tax", "target_value_2027": "l_discount"}


@query(
    "unpivot_ordered",
    "\nUNION ALL\n".join(
        f"SELECT l_orderkey, l_linenumber, l_partkey, CAST({name[-4:]} AS INTEGER) AS year, {source} AS value, {i} AS var_pos FROM lineitem"
        for i, (name, source) in enumerate(_MEASURES.items())
    ),
)
def unpivot_measures(spark, sf):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    wide = table(spark, sf, "lineitem").select(*ids, *[F.col(s).alias(n) for n, s in _MEASURES.items()])
    long = unpivot_ordered(wide, ids, list(_MEASURES), "year", "value", "var_pos")
    return long.withColumn("year", year_in_name(F.col("year")))


@query(
    "pivot_years",
    """SELECT s_suppkey, """
    + ", ".join(f'max(CASE WHEN y = {y} THEN qty END) AS "{y}_qty", max(CASE WHEN y = {y} THEN n END) AS "{y}_n"' for y in range(1995, 2002))
    + """ FROM (SELECT l_suppkey AS s_suppkey, year(l_shipdate) AS y, sum(l_quantity) AS qty, count(*) AS n FROM lineitem GROUP BY ALL)
    GROUP BY 1""",
)
def supplier_years(spark, sf):
    yearly = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year"))
        .agg(F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n"))
    )
    return pivot_years(yearly, ["s_suppkey"], "year", range(1995, 2002), ["qty", "n"])
