import math
import random

import pytest

from fieldmark.operators.cumulate import cumulate
from fieldmark.operators.gapfill import gap_fill
from fieldmark.operators.override import override
from fieldmark.operators.rollup import rollup
from fieldmark.schema import SOURCED_VALUE, VALUE

FIELDS = VALUE.names


def table(spark, *rows, schema=VALUE):
    """Value rows from (code, unit, year, level, country, region) and further fields by name."""
    out = []
    for code, unit, year, level, country, region, more in rows:
        row = {
            "indicator_code": code, "indicator_name": f"n{code}", "unit": unit, "date": year, "project": "new",
            "level": level, "country": country, "region": region, "indicator_changed": False, **more,
        }
        out.append(tuple(row.get(f) for f in schema.names))
    return spark.createDataFrame(out, schema)


def v(value=None, num=None, den=None, **more):
    return {"value": value, "numerator": num, "denominator": den, **more}


def values(df):
    return {(r.indicator_code, r.date, r.level, r.country, r.region): r.value for r in df.collect()}


def test_rollup_sums_ratios_means_flags(spark):
    df = table(
        spark,
        ("C", "count", 2022, 6, "A", "r1", v(3.0)),
        ("C", "count", 2022, 6, "A", "r1", v(4.0)),
        ("C", "count", 2022, 6, "A", "r2", v(None)),
        ("P", "percent", 2022, 6, "A", "r1", v(0.9, 1.0, 4.0)),
        ("P", "percent", 2022, 6, "A", "r1", v(0.9, 3.0, 4.0)),
        ("M", "percent", 2022, 2, "A", None, v(0.2)),
        ("M", "percent", 2022, 2, "B", None, v(0.4)),
        ("B", "boolean", 2022, 2, "A", None, v(None)),
        ("F", "boolean", 2022, 2, "A", None, v(1.0)),
        ("F", "boolean", 2022, 2, "B", None, v(0.0)),
        ("X", "other", 2022, 6, "A", "r1", v(1.0)),
        ("D", "count", 2022, 5, "A", "r1", v(1.0)),
    )
    got = values(rollup(df))
    assert got[("C", 2022, 3, "A", "r1")] == 7 and got[("C", 2022, 3, "A", "r2")] == 0.0
    assert got[("C", 2022, 2, "A", None)] == 7 and got[("C", 2022, 1, "Régional", None)] == 7
    assert got[("P", 2022, 3, "A", "r1")] == 0.5 and got[("P", 2022, 1, "Régional", None)] == 0.5
    assert got[("M", 2022, 1, "Régional", None)] == pytest.approx(0.3)
    assert got[("B", 2022, 1, "Régional", None)] == 1.0 and got[("F", 2022, 1, "Régional", None)] == 0.0
    assert not [k for k in got if k[0] in ("X", "D")]


def test_reported_beats_rolled_up_and_counts_twice_above(spark):
    df = table(
        spark,
        ("C", "count", 2022, 6, "A", "r1", v(7.0)),
        ("C", "count", 2022, 2, "A", None, v(10.0)),
    )
    got = values(rollup(df))
    assert got[("C", 2022, 2, "A", None)] == 10 and got[("C", 2022, 1, "Régional", None)] == 17
    once = values(rollup(df, dedup_each_level=True))
    assert once[("C", 2022, 1, "Régional", None)] == 10


def test_ratio_beats_mean_and_division_by_zero(spark):
    df = table(
        spark,
        ("P", "percent", 2022, 6, "A", "r1", v(None, 1.0, 2.0)),
        ("P", "percent", 2022, 6, "A", "r1", v(0.9)),
        ("Z", "percent", 2022, 6, "A", "r1", v(None, 0.0, 0.0)),
    )
    got = values(rollup(df))
    assert got[("P", 2022, 3, "A", "r1")] == 0.5
    assert math.isnan(got[("Z", 2022, 3, "A", "r1")])


def test_history_comes_before_surveys(spark):
    df = table(
        spark,
        ("C", "count", 2022, 2, "A", None, v(1.0)),
        ("C", "count", 2022, 2, "A", None, v(2.0)),
    )
    from pyspark.sql import functions as F

    ranked = df.withColumn("src_rank", F.when(F.col("value") == 2, 0).otherwise(1))
    assert values(rollup(ranked))[("C", 2022, 2, "A", None)] == 2.0


def test_the_first_report_of_a_source_wins(spark):
    df = table(
        spark,
        ("C", "count", 2022, 2, "A", None, v(50.0)),
        ("C", "count", 2022, 2, "A", None, v(20.0)),
        ("C", "count", 2022, 2, "A", None, v(10.0)),
    )
    from pyspark.sql import functions as F

    line = F.when(F.col("value") == 50, 7).when(F.col("value") == 20, 9).cast("long")
    assert values(rollup(df.withColumn("src_line", line)))[("C", 2022, 2, "A", None)] == 50.0


def test_gap_fill_golden(spark):
    df = table(
        spark,
        ("X", "count", 2021, 1, "Régional", None, v(1.0)),
        ("X", "count", 2023, 1, "Régional", None, v(2.0)),
    )
    got = {r.date: (r.value, r.project, r.indicator_name) for r in gap_fill(df, "old", "new").collect()}
    assert got == {2021: (1.0, "new", "nX"), 2022: (None, "new", "nX"), 2023: (2.0, "new", "nX")}


def test_gap_fill_levels(spark):
    df = table(
        spark,
        ("X", "count", 2022, 3, "A", "r1", v(1.0)),
        ("X", "count", 2022, 2, "A", None, v(1.0)),
        ("Y", "count", 2022, 2, "B", None, v(1.0)),
        ("X", "count", 2022, 3, "C", "r9", v(1.0)),  # C has no country row
        (None, "count", 2022, 2, "B", None, v(1.0)),
    )
    got = {(r.indicator_code, r.date, r.level, r.country, r.region) for r in gap_fill(df, "old", "new").collect()}
    want = {(c, y, 1, "Régional", None) for c in "XY" for y in (2021, 2022)}
    want |= {(c, y, 2, p, None) for c in "XY" for y in (2021, 2022) for p in "AB"}
    want |= {("X", y, 3, "A", "r1") for y in (2021, 2022)} | {("X", 2022, 3, "C", "r9"), (None, 2022, 2, "B", None)}
    assert got == want
    old = {(r.date, r.project) for r in gap_fill(df, "old", "new").filter("value is null").collect()}
    assert old == {(2021, "old"), (2022, "new")}


def test_gap_fill_before_the_first_year(spark):
    df = table(spark, ("X", "count", 2020, 1, "Régional", None, v(1.0)))
    assert gap_fill(df, "old", "new").count() == 1


def test_override_by_independent_sets_and_by_tuple(spark):
    base = table(
        spark,
        ("A", "count", 2025, 2, "X", None, v(1.0)),
        ("A", "count", 2025, 2, "Y", None, v(2.0)),
        ("B", "count", 2025, 2, "X", None, v(3.0)),
        (None, "count", 2025, 2, "X", None, v(4.0)),
    )
    official = table(
        spark,
        ("A", "count", 2025, 2, "X", None, v(10.0)),
        ("B", "count", 2025, 2, "Y", None, v(20.0)),
    )
    assert sorted(r.value for r in override(base, official).collect()) == [4.0, 10.0, 20.0]
    assert sorted(r.value for r in override(base, official, match="tuple").collect()) == [2.0, 3.0, 4.0, 10.0, 20.0]


def sourced(spark, *rows):
    return table(
        spark, *[(*r[:6], {"data_source": "survey", **r[6]}) for r in rows], schema=SOURCED_VALUE
    )


def cumulated(df):
    return {
        (r.indicator_code, r.date): (r.cumulated_value, r.cumulated_value_current)
        for r in cumulate(df, "old", "new").collect()
    }


def test_running_counts_by_project(spark):
    df = sourced(
        spark,
        ("C", "count", 2021, 1, "R", None, v(5.0, project="old")),
        ("C", "count", 2022, 1, "R", None, v(3.0)),
        ("C", "count", 2023, 1, "R", None, v(None)),
        ("C", "count", 2022, 6, "R", None, v(3.0)),
    )
    assert cumulated(df) == {("C", 2021): (5.0, None), ("C", 2022): (8.0, 3.0), ("C", 2023): (8.0, 3.0)}


def test_official_count_stands_and_is_added_later(spark):
    df = sourced(
        spark,
        ("C", "count", 2024, 2, "A", None, v(8.0)),
        ("C", "count", 2025, 2, "A", None, v(20.0, data_source="official")),
        ("C", "count", 2026, 2, "A", None, v(1.0)),
    )
    assert cumulated(df) == {("C", 2024): (8.0, 8.0), ("C", 2025): (20.0, 20.0), ("C", 2026): (29.0, 29.0)}


def test_running_ratios_and_flags(spark):
    df = sourced(
        spark,
        ("P", "percent", 2021, 1, "R", None, v(0.5, 1.0, 2.0, project="old")),
        ("P", "percent", 2022, 1, "R", None, v(0.5, 1.0, 2.0)),
        ("P", "percent", 2023, 1, "R", None, v(None)),
        ("P", "percent", 2024, 1, "R", None, v(0.0, 1.0, 6.0)),
        ("Q", "percent", 2022, 1, "R", None, v(0.3)),
        ("B", "boolean", 2022, 6, "R", None, v(1.0)),
        ("X", "other", 2022, 1, "R", None, v(1.0)),
    )
    got = cumulated(df)
    assert math.isnan(got.pop(("Q", 2022))[0])
    assert got == {
        ("P", 2021): (None, None), ("P", 2022): (0.5, 0.5), ("P", 2023): (0.5, 0.5), ("P", 2024): (0.25, 0.25),
        ("B", 2022): (1.0, 1.0),
    }


def test_rollup_hashes_reported_rows_and_reads_them_once(spark, tmp_path):
    path = str(tmp_path / "facts")
    many = [("C", "count", 2022, 2, country, None, v(float(i % 7) if i % 50 else None)) for i in range(200) for country in "AB"]
    table(spark, *many, ("C", "count", 2022, 6, "A", "r1", v(2.0))).withColumnRenamed("value", "kept_value").write.parquet(path)
    out = rollup(spark.read.parquet(path).withColumnRenamed("kept_value", "value"))
    got = values(out)
    assert got[("C", 2022, 2, "A", None)] is None and got[("C", 2022, 3, "A", "r1")] == 2.0
    assert got[("C", 2022, 1, "Régional", None)] == 2.0 + 2 * sum(i % 7 for i in range(200) if i % 50)
    run = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Final Plan" in run and "kept_value" not in run


def test_reported_rows_of_all_kinds_agree_with_loops(spark):
    rng = random.Random(3)

    def some(choices):
        return rng.choice([None, *choices])

    rows, facts = [], []
    for i in range(600):
        # codes with lines everywhere, in places, and nowhere; with and without numerators and denominators
        code, unit = f"c{i % 6}", ("count", "percent", "boolean", "other", "percent", None)[i // 6 % 6]
        line = (rng.randrange(40), some(range(6)), None)[i % 3]
        terms = (some([1.0, 2.0]), some([0.0, 4.0])) if i % 2 else (None, None)
        rank, project, country = some([0, 1]), rng.choice("pq"), rng.choice([None, "A"])
        more = v(some([0.0, 1.0, float("nan")]), *terms, project=project)
        rows.append((code, unit, 2022, 2, country, None, more))
        facts.append((f"c{i % 6}", country, rank, line, f"n{code}", unit, project, more["value"], *terms))
    base = table(spark, *rows)
    ranks = [(f[2], f[3]) for f in facts]
    schema = VALUE.jsonValue()
    schema["fields"] += [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in (("src_rank", "integer"), ("src_line", "long"))]
    df = spark.createDataFrame([tuple(r) + extra for r, extra in zip(base.collect(), ranks)], type(VALUE).fromJson(schema))

    def nulls_first(x):
        return (x is not None, x != x, 0 if x is None or x != x else x)

    def order(fact):
        rank, line, *tie = fact[2:]
        return [nulls_first(rank), line is None, line or 0, *map(nulls_first, tie)]

    for once in (False, True):
        got = {(r.indicator_code, r.country): r for r in rollup(df, dedup_each_level=once).collect() if r.level == 2}
        assert len(got) == 12
        for (code, country), r in got.items():
            first = min((f for f in facts if f[:2] == (code, country)), key=order)
            assert str((r.indicator_name, r.unit, r.project, r.value, r.numerator, r.denominator)) == str(first[4:])
