import math
import random

import pytest
from pyspark.sql import functions as F

from fieldmark.operators import near
from fieldmark.operators.near import near_duplicate_ids, neighbour_counts
from fieldmark.session import settle


def distance(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2
    h += math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6372.8 * math.asin(math.sqrt(h))


def by_brute_force(data, limit):
    near = {i: {i} for i, _, _ in data}
    for i, a, b in data:
        for j, c, d in data:
            if i < j and (round(a, 2), round(b, 2)) == (round(c, 2), round(d, 2)) and distance(a, b, c, d) <= limit:
                near[i].add(j)
                near[j].add(i)
    ids, seen = {i: i for i in near}, set()
    for i in sorted(near):
        group = tuple(sorted(near[i]))
        if len(group) > 1 and group not in seen:
            seen.add(group)
            for member in group:
                ids[member] = group[0]
    return ids, {i: len(n) - 1 for i, n in near.items()}


def spots(n, cells, seed):
    r = random.Random(seed)
    data = []
    for i in range(n):
        lat = 14.0 + 0.01 * r.randrange(cells) + r.uniform(-0.0049, 0.0049)
        lon = -3.0 + r.uniform(-0.0049, 0.0049)
        if data and r.random() < 0.2:
            _, lat, lon = r.choice(data)
        data.append((i, lat, lon))
    return data


@pytest.mark.parametrize(("n", "cells", "few", "limit"), [(250, 2, 1, 1.0), (250, 2, near.FEW, 1.0), (300, 2, 40, 0.5), (150, 3, 4, 0.3)])
def test_equals_brute_force(spark, n, cells, few, limit):
    data = spots(n, cells, n + few)
    df = spark.createDataFrame([*data, (n, None, 1.0)], "id long, lat double, lon double")
    want, counts = by_brute_force(data, limit)
    got = near_duplicate_ids(df, "id", "lat", "lon", limit, few=few)
    assert {x["id"]: x["infrastructure_id"] for x in got.collect()} == {**want, n: n}
    counted = neighbour_counts(df, "id", "lat", "lon", limit, few=few)
    assert {x["id"]: x["n_neighbours"] for x in counted.collect()} == {**counts, n: 0}


def connected(data, limit):
    """Smallest id of each component, comparing every pair."""
    least = {i: i for i, _, _ in data}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, a, b in data:
        for j, c, d in data:
            if i < j and (round(a, 2), round(b, 2)) == (round(c, 2), round(d, 2)) and distance(a, b, c, d) <= limit:
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return {i: root(i) for i in least}


@pytest.mark.parametrize(("n", "cells", "few", "limit"), [(200, 2, 1, 0.1), (200, 2, near.FEW, 0.06), (120, 1, 6, 0.3), (60, 3, 4, 2.0), (150, 1, 2, 0.02)])
def test_components_equal_brute_force(spark, n, cells, few, limit):
    data = spots(n, cells, n)
    df = spark.createDataFrame([*data, (n, None, 1.0)], "id long, lat double, lon double")
    got = near_duplicate_ids(df, "id", "lat", "lon", limit, few=few, mode="components")
    assert {x["id"]: x["infrastructure_id"] for x in got.collect()} == {**connected(data, limit), n: n}


def test_components_edges(spark):
    # a chain along a cell, far north, where a degree of longitude is short
    chain = [(i, 70.0, 20.0 - 0.0045 + 0.0003 * i) for i in range(30)]
    df = spark.createDataFrame(chain, "id long, lat double, lon double")
    step = distance(*chain[0][1:], *chain[1][1:])
    one = near_duplicate_ids(df, "id", "lat", "lon", step * 1.01, mode="components")
    assert {x["infrastructure_id"] for x in one.collect()} == {0}
    apart = near_duplicate_ids(df, "id", "lat", "lon", step * 0.99, mode="components")
    assert apart.select("infrastructure_id").distinct().count() == 30
    assert near_duplicate_ids(df.limit(0), "id", "lat", "lon", 0.1, mode="components").count() == 0
    with pytest.raises(ValueError):
        near_duplicate_ids(df, "id", "lat", "lon", 1e-9, mode="components")
    with pytest.raises(ValueError):
        near_duplicate_ids(df, "id", "lat", "lon", 1.0, mode="both")


def test_work_follows_links_where_one_square_holds_most_points(spark):
    """20,000 points within ten metres, a reach of two: far finer than any grid laid in advance."""
    dense = spark.range(20_000).selectExpr("id", "14.001 + rand(1) * 0.00009 as lat", "-3.001 + rand(2) * 0.00009 as lon")
    dense = settle(dense)
    points = settle(near._points(dense, "id", "lat", "lon", 2))
    pairs, deepest = near._square_pairs(points, 0.002, 256)
    compared = pairs.filter("verdict = 'points'").agg({"n_pairs": "sum"}).first()[0]
    links = neighbour_counts(dense, "id", "lat", "lon", 0.002, few=256).agg({"n_neighbours": "sum"}).first()[0]
    assert deepest >= 4 and 0 < compared < links
    n_pairs = pairs.count()
    assert n_pairs < links / 10


def test_chain_is_one_hop(spark):
    # 1-2 and 2-3 are near, 1-3 is not
    step = 0.0045
    df = spark.createDataFrame([(1, 13.9955, -3.0), (2, 13.9955 + step, -3.0), (3, 13.9955 + 2 * step, -3.0)], "id int, lat double, lon double")
    got = near_duplicate_ids(df, "id", "lat", "lon", 0.6)
    assert {x["id"]: x["infrastructure_id"] for x in got.collect()} == {1: 1, 2: 2, 3: 2}


def test_points_travel_as_lists_and_unfold_beside_the_points_they_meet(spark):
    grid = spark.range(600).selectExpr("id", "14 + id % 20 / 2500D AS lat", "-3 + id % 15 / 2500D AS lon")
    settled = settle(near._points(grid, "id", "lat", "lon", 2))
    pairs = near._square_pairs(settled, 0.4, 64)
    assert pairs[0].filter("verdict = 'points'").count() > 0
    folded = near._fold(settled, pairs, {"n_rows": F.sum("n_rows"), "points": F.sum("points")}, 0.4, {"points": F.lit(1)})
    plan = folded._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Generate explode(there") < plan.index("ShuffledHashJoin")
    every = settled.collect()
    for r in folded.collect():
        hood = [p for p in every if (p.cell_lat, p.cell_lon) == (r.cell_lat, r.cell_lon) and distance(r.lat, r.lon, p.lat, p.lon) <= 0.4]
        assert (r.n_rows, r.points) == (sum(p.n_rows for p in hood), len(hood))
    assert folded.count() == len(every)
