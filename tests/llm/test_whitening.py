"""Whitening against numpy over whole lists."""

import math
import random

import numpy as np
import pytest

from fieldmark.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, dim int, rows string"


def plain(vectors, k=8):
    """n, exact deviations, whitened and explained of a list of vectors."""
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    away = (x * n - sums).astype(float) / n
    covariance = away.T @ away / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, [int(((row * n - sums) ** 2).sum()) for row in x], away @ axes / np.sqrt(values), values / np.trace(covariance)


def check(rows, vectors):
    n, deviations, whitened, explained = plain([v for _, v in vectors])
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, []).append(r)
    assert sorted(by_id) == sorted({i for i, _ in vectors})
    got = np.array([by_id[i][0].whitened for i, _ in vectors])
    sign = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got - whitened * sign).max() < 1e-8
    for (i, _), deviation in zip(vectors, deviations, strict=True):
        assert all(r.n == n and int(r.deviation) == deviation for r in by_id[i])
        assert np.allclose(by_id[i][0].explained, explained, rtol=1e-9) and by_id[i][0].identity_error < 1e-8


def test_equals_numpy_with_a_hot_vector(spark):
    rng = random.Random(1)
    distinct = [[rng.gauss(0, 1 + k) for k in range(10)] for _ in range(300)]
    vectors = [(i, distinct[0] if i % 3 == 0 else rng.choice(distinct)) for i in range(1500)]
    bad = [(9001, None), (9002, [None, *distinct[0][1:]]), (9003, [float("nan")] * 10), (9004, [float("inf"), *distinct[0][1:]]), (9005, [])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors + bad], SCHEMA).repartition(4)
    check(W.whiten(table).collect(), vectors)
    flat = W.by_component(W.whiten(table, components=3)).collect()
    assert len(flat) == 4500 and {r.component for r in flat} == {1, 2, 3}


def test_one_as_weight_fits_the_distinct_vectors(spark):
    rng = random.Random(2)
    distinct = [(i, [rng.gauss(0, 1 + k) for k in range(4)]) for i in range(50)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in distinct for _ in range(1 + i % 3)], SCHEMA)
    rows = W.whiten(table, components=4, weights="one").collect()
    assert len(rows) == sum(1 + i % 3 for i, _ in distinct)
    check(rows, distinct)
    with pytest.raises(ValueError):
        W.whiten(table, weights="two")


def test_lengths_apart_and_large_entries(spark):
    rng = random.Random(3)
    short = [(i, [rng.gauss(0, 1), rng.gauss(5, 2)]) for i in range(40)]
    huge = [(100 + i, [rng.gauss(0, 1) * 1e12, rng.gauss(0, 1) * 1e12, 1.0 * (i % 2)]) for i in range(40)]
    rows = W.whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in short + huge], SCHEMA).repartition(3)).collect()
    check([r for r in rows if r.dim == 2], short)
    n, deviations, _, _ = plain([v for _, v in huge])
    found = {r.vec_id: r for r in rows if r.dim == 3}
    assert all(found[i].n == n and int(found[i].deviation) == d for (i, _), d in zip(huge, deviations, strict=True))


def test_beyond_a_long(spark):
    table = spark.createDataFrame([(1, [1e300, 0.0], 1, "x"), (2, [-1e300, 1.0], 1, "x"), (3, [0.0, 5.0], 1, "x")], SCHEMA)
    rows = W.by_component(W.whiten(table)).collect()
    assert len(rows) == 6 and all(r.deviation is None for r in rows if r.vec_id != 3)


def test_tables_without_variance(spark):
    one = spark.createDataFrame([(None, [1.0, 2.0], 1, "x"), (None, [1.0, 2.0], 1, "x")], SCHEMA)
    rows = W.by_component(W.whiten(one)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(2, 0, None, None, None)] * 4
    line = spark.createDataFrame([(i, [float(i), 0.0], 1, "x") for i in range(5)], SCHEMA)
    rows = W.by_component(W.whiten(line)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in rows) and rows[0].identity_error < 1e-12
    assert W.by_component(W.whiten(one.limit(0))).count() == 0


def test_explained_adds_up(spark):
    rng = random.Random(4)
    table = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(6)], 1, "x") for i in range(200)], SCHEMA)
    first = W.whiten(table).first()
    assert math.isclose(sum(first.explained), 1.0) and first.explained == sorted(first.explained, reverse=True)
