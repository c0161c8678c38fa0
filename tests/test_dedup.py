import random
import re
from datetime import date

from pyspark.sql import functions as F

from fieldmark.operators import dedup
from fieldmark.sources import readers, sinks


def test_keep_first_nulls_first(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", None, "y"), (None, 1, "z"), (None, 0, "w")], "k string, p int, v string")
    assert rows(dedup.keep_first(df, ["k"], [F.col("p")]), "k", "v") == [(None, "w"), ("a", "y")]


def test_latest_null_date_wins_by_default(spark, rows):
    df = spark.createDataFrame(
        [(1, date(2023, 1, 1), 1), (1, None, 2), (2, date(2022, 1, 1), 3), (2, date(2022, 1, 1), 4)],
        "id int, d date, sub int",
    )
    assert rows(dedup.latest_per_key(df, ["id"], "d", ["sub"]), "id", "sub") == [(1, 2), (2, 4)]
    assert rows(dedup.latest_per_key(df, ["id"], "d", ["sub"], nulls="last"), "id", "sub") == [(1, 1), (2, 4)]


def test_snapshots_golden(spark, rows):
    df = spark.createDataFrame(
        [(1, date(2021, 5, 1), "a"), (1, date(2023, 5, 1), "b"), (2, date(2024, 1, 1), "c"), (3, None, "d")],
        "id int, DATE date, v string",
    )
    got = rows(dedup.yearly_snapshots(df, "id", "DATE"), "id", "over_year", "v")
    assert got == [(1, 2021, "a"), (1, 2022, "a"), (1, 2023, "b"), (1, 2024, "b"), (2, 2024, "c")]


def test_snapshots_equal_a_loop_over_years(spark, rows):
    r = random.Random(3)
    data = [(r.randrange(12), date(r.randrange(2018, 2026), r.randrange(1, 13), r.randrange(1, 29)), i) for i in range(150)]
    df = spark.createDataFrame(data, "id int, d date, sub int")
    want = []
    for year in range(min(d.year for _, d, _ in data), max(d.year for _, d, _ in data) + 1):
        best = {}
        for i, d, sub in data:
            if d.year <= year and (i not in best or (d, sub) > best[i]):
                best[i] = (d, sub)
        want += [(i, year, sub) for i, (_, sub) in best.items()]
    got = [tuple(x) for x in dedup.yearly_snapshots(df, "id", "d", ["sub"]).select("id", "over_year", "sub").collect()]
    assert sorted(got) == sorted(want)


def test_keep_lone_or_marked(spark, rows):
    data = [("k", "MR", "MR"), ("k", "MR restruc", "MR"), ("k", "NE", "NE"), ("k", "TD", "TD"), ("k", "TD", "TD"), (None, "SN", "SN")]
    df = spark.createDataFrame(data, "name string, country string, clean string")
    got = rows(dedup.keep_lone_or_marked(df, ["name", "clean"], F.col("country").contains("restruc")), "country")
    assert got == [("MR restruc",), ("NE",), ("SN",)]


def test_wide_rows_come_by_their_place(spark, rows, tmp_path):
    data = [(k, i % 4, i, "x" * 50) for i, k in enumerate(["a", "b", None, "a", "a", None, "c"] * 6)]
    wide = spark.createDataFrame(data, "k string, d int, i int, t string")
    wide.repartition(3).write.parquet(str(tmp_path / "wide"))
    read = spark.read.parquet(str(tmp_path / "wide"))
    order = [F.col("d"), F.col("i")]
    first = dedup.keep_first(dedup.with_places(read), ["k"], order, dedup.PLACE).select(*wide.columns)
    assert rows(first) == rows(dedup.keep_first(wide, ["k"], order)) and first.count() == 4
    latest = dedup.latest_per_key(read, ["k"], "d", ["i"], place=["i"])
    assert rows(latest) == rows(dedup.latest_per_key(wide, ["k"], "d", ["i"]))
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any(re.search(r"\bt#", line) for line in aggregates)
    # equal ranks: one row of the key, the same each time
    tied = [dedup.keep_first(dedup.with_places(read), ["k"], [F.lit(0)], dedup.PLACE).select("k", "i") for _ in range(2)]
    assert rows(tied[0]) == rows(tied[1]) and tied[0].count() == 4


def test_snapshots_as_intervals(spark, rows, tmp_path):
    data = [("a", date(2001, 1, 1), 1), ("a", date(2001, 5, 1), 2), ("a", date(2004, 1, 1), 3), ("b", date(2003, 1, 1), 4), ("b", None, 5), ("c", date(2020, 1, 1), 6)]
    df = spark.createDataFrame(data, "id string, d date, i int")
    changes = dedup.yearly_changes(df, "id", "d", ["i"], place=["i"])
    assert rows(changes, "id", "i", "valid_from", "valid_to") == [("a", 2, 2001, 2003), ("a", 3, 2004, None), ("b", 4, 2003, None), ("c", 6, 2020, None)]
    sinks.store_changes(changes, str(tmp_path / "changes"))
    assert spark.read.parquet(str(tmp_path / "changes")).count() == 4  # however many years there are
    every = readers.snapshots(spark, str(tmp_path / "changes"))
    assert rows(every, "id", "over_year", "i") == rows(dedup.yearly_snapshots(df, "id", "d", ["i"]), "id", "over_year", "i") and every.count() == 20 + 18 + 1
    one = readers.snapshots(spark, str(tmp_path / "changes"), 2003)
    assert rows(one, "id", "i", "over_year") == [("a", 2, 2003), ("b", 4, 2003)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(valid_from,2003)" in plan
