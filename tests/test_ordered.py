import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldmark.functions import exact
from fieldmark.operators import ordered


def sample(spark, seed=1, n=400):
    r = random.Random(seed)
    # one key holds more than half of the rows; one key is null
    keys = ["hot"] * 6 + ["a", "b", None]
    data = [(r.choice(keys), i * 3, r.choice([None, 1.0, 2.0, 5.0]), r.choice(["x", "y", None])) for i in range(n)]
    r.shuffle(data)
    return spark.createDataFrame(data, "k string, pos long, v double, t string")


def block():
    return [F.floor(F.col("pos") / 100)]


def same(got, want):
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_running_sum_equals_plain_window(spark):
    df = sample(spark)
    w = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("s", F.sum(F.coalesce("v", F.lit(0))).over(w))
    same(ordered.running_sum(df, ["k"], ["pos"], {"s": F.col("v")}, block()), want)


def test_row_index(spark):
    df = sample(spark)
    want = df.withColumn("i", (F.row_number().over(Window.partitionBy("k").orderBy("pos")) - 1).cast("long"))
    same(ordered.row_index(df, ["k"], ["pos"], "i", block()), want)


def test_forward_fill_equals_plain_window(spark):
    df = sample(spark)
    w = Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("v", "t")})
    same(ordered.forward_fill(df, ["k"], ["pos"], ["v", "t"], block()), want)


def test_previous_value_equals_lag(spark):
    df = sample(spark)
    want = df.withColumn("p", F.lag("t").over(Window.partitionBy("k").orderBy("pos")))
    same(ordered.previous_value(df, ["k"], ["pos"], {"p": "t"}, block()), want)


def test_change_counter_equals_plain_windows(spark):
    df = sample(spark).withColumn("parent", F.when(F.col("v") == 5.0, "p").otherwise("q"))
    lagged = df.withColumn("p", F.lag("t").over(Window.partitionBy("k").orderBy("pos")))
    w = Window.partitionBy("k", "parent").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    changed = F.coalesce(F.col("t") != F.col("p"), F.lit(False)).cast("int")
    want = lagged.withColumn("n", F.sum(changed).over(w))
    same(ordered.change_counter(df, ["k"], ["parent"], ["pos"], "t", "n", block()), want)


def test_two_column_block(spark):
    df = sample(spark).withColumn("part", (F.col("pos") % 2).cast("int"))
    w = Window.partitionBy("k").orderBy("part", "pos").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("t", F.last("t", ignorenulls=True).over(w))
    got = ordered.forward_fill(df, ["k"], ["part", "pos"], ["t"], [F.col("part"), F.floor(F.col("pos") / 90)])
    same(got, want)


def test_empty(spark):
    df = sample(spark).filter("false")
    assert ordered.running_sum(df, ["k"], ["pos"], {"s": F.col("v")}, block()).count() == 0
    assert ordered.forward_fill(df, ["k"], ["pos"], ["t"], block()).count() == 0


def exactly(values):
    """The sum of floats, rounded once."""
    return float(sum(map(Fraction, values), Fraction(0)))


def test_running_sums_of_fractions_are_exact_for_any_blocks(spark):
    r = random.Random(4)
    data = [("a" if i % 3 else "b", i, r.choice([-1, 1]) * r.random() * 10 ** r.randint(-9, 12)) for i in range(600)]
    data[7] = ("a", 7, None)
    df = spark.createDataFrame(data, "k string, pos long, v double").repartition(5)
    want, so_far = {}, {"a": [], "b": []}
    for k, pos, v in data:
        so_far[k].append(v or 0.0)
        want[pos] = exactly(so_far[k])
    for width in (7, 100, 10_000):
        got = ordered.running_sum(df, ["k"], ["pos"], {"s": F.col("v")}, [F.floor(F.col("pos") / width)])
        assert {r.pos: r.s for r in got.collect()} == want


def test_grouped_sums_of_fractions(spark):
    r = random.Random(5)
    values = [r.choice([-1, 1]) * r.random() * 2.0 ** r.randint(-25, 70) for _ in range(3000)] + [1e-40, -1e-40, 0.1, -0.1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    sums = {exact.sum_exactly(df.repartition(n), [], {"s": F.col("v")}).first().s for n in (1, 3, 8)}
    assert sums == {exactly(values)}
    odd = [([float("inf"), 1.0], float("inf")), ([float("-inf")], float("-inf")), ([None], None), ([-0.5, 0.25], -0.25), ([], None)]
    for given, expected in odd:
        assert exact.sum_exactly(spark.createDataFrame([(v,) for v in given], "v double"), [], {"s": F.col("v")}).first().s == expected
    both = exact.sum_exactly(spark.createDataFrame([(float("inf"),), (float("-inf"),)], "v double"), [], {"s": F.col("v")})
    assert math.isnan(both.first().s)
    with pytest.raises(Exception, match="OVERFLOW"):
        exact.sum_exactly(spark.createDataFrame([(1e300,)], "v double"), [], {"s": F.col("v")}).collect()


def test_a_tree_of_several_levels(spark):
    blocks = [(b, b * 3 + 1, f"t{b}" if b % 5 == 0 else None) for b in [*range(-40, 200), 5000, 70_000, 70_001]]
    df = spark.createDataFrame(blocks, "__block long, s long, t string").repartition(4)
    total, last, want = None, None, {}
    for b, s, t in blocks:
        want[b] = (total, last)
        total, last = (total or 0) + s, t or last
    for fan in ((12,), (3,), (2, 2, 2), ()):
        made = ordered._before(df, [], ["__block"], ["s"], ["t"], fan)
        assert {r["__block"]: (r.s, r.t) for r in made.collect()} == want


def test_no_task_gets_all_summaries(spark):
    df = sample(spark)
    plan = ordered.forward_fill(df, [], ["pos"], ["v"], block())._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_previous_value_may_be_null_across_blocks(spark):
    df = spark.createDataFrame([(i, "a" if i % 7 == 0 else None) for i in range(60)], "pos long, t string")
    got = ordered.previous_value(df, [], ["pos"], {"p": "t"}, [F.floor(F.col("pos") / 4)])
    assert {r.pos: r.p for r in got.collect()} == {i: ("a" if i and (i - 1) % 7 == 0 else None) for i in range(60)}
