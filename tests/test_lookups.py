import random

import pytest
from pyspark.sql import functions as F

from fieldmark.operators import lookups
from fieldmark.operators.rollup import rollup
from fieldmark.schema import VALUE


def test_attach_keeps_left_rows_and_nulls_match_nothing(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("a", "A"), ("a", "AA"), (None, "N")], "key string, label string")
    got = rows(lookups.attach(left, right, {"k": "key"}, {"name": "label"}), "k", "x", "name")
    assert got == [(None, 3, None), ("a", 1, "A"), ("a", 1, "AA"), ("b", 2, None)]


def test_the_only(spark):
    once = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    assert lookups.the_only(once, ["k"], ["x"]).count() == 2
    with pytest.raises(Exception, match="more than one row"):
        lookups.the_only(once.unionByName(once), ["k"], ["x"]).collect()


def test_first_match_by_file_order(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, line int, unit string")
    assert rows(lookups.first_match(df, ["k"], ["line"]), "k", "unit") == [("a", "y"), ("b", "z")]


def test_sets(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "m string")
    assert rows(lookups.not_among(df, known, {"k": "m"})) == [(None,), ("b",)]
    assert rows(lookups.is_among(df, known, "k", "f"), "k", "f") == [(None, False), ("a", True), ("b", False)]


def test_every_pair(spark, rows):
    left = spark.createDataFrame([(i,) for i in range(7)], "i int")
    right = spark.createDataFrame([(c,) for c in ("x", "y", None)], "c string")
    got = lookups.every_pair(left, right, spread=4)
    assert got.count() == 21 and got.distinct().count() == 21


def test_sums_are_conserved_up_the_hierarchy(spark):
    r = random.Random(8)
    facts = [
        ("C", "n", "count", r.choice([2022, 2023]), "p", 6, r.choice("AB"), r.choice(["r1", "r2", "r3"]), None, None, float(r.randrange(50)), False)
        for _ in range(400)
    ]
    rolled = rollup(spark.createDataFrame(facts, VALUE))
    per_level = {
        (row.level, row.date): row.total
        for row in rolled.groupBy("level", "date").agg(F.sum("value").alias("total")).collect()
    }
    for year in (2022, 2023):
        total = sum(f[10] for f in facts if f[3] == year)
        assert per_level[(1, year)] == per_level[(2, year)] == per_level[(3, year)] == total
