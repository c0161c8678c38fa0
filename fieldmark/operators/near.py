"""Near-duplicate places: rows a short distance apart get one common id.

Two rows are neighbours if they lie in the same rounded cell and at most
``max_km`` apart.  The neighbourhood N[i] of a row is itself and its neighbours.
Taking the distinct neighbourhoods in the order of the first row that has each,
every one in turn gives all its members its smallest id, later ones overriding.
In closed form, with pos(i) the smallest j for which N[j] = N[i]: the id of x is
min N[i*], where i* has the largest pos among the members of N[x].

So all that is needed of a neighbourhood is a few folds over it: smallest id,
a fingerprint that tells equal sets, and the largest (pos, min) among members.
The pairs themselves are not.  A cell may hold a third of all rows, and nearly
all of its pairs would be neighbours, so they are not formed:

* rows with the same coordinates have the same neighbourhood and are folded into
  one point first, by an ordinary aggregation;
* a cell is the root of a tree of squares, each cut into 8 x 8.  For two squares
  wholly within reach of each other, the fold over one is handed to the other as a
  single value; two squares wholly out of reach contribute nothing.  Of the pairs
  that straddle the limit, those with few points are compared point by point, and
  the others are cut further: how deep depends on the points counted there, down to
  squares of a tenth of a millimetre.  So a point meets points of a thin ring, however
  many share its square or its cell.

Joins are left to Spark, whose skew rule splits what a full square makes long.

``mode="components"`` instead gives all rows of a chain of neighbours one id.  Its
graph is linked square by square: in squares of a diagonal within reach all points are
one, and of two such squares it only matters whether any two points are within reach,
which the same tree decides, leaving a pair of squares at the first hit.

Bounds come from the outermost points of each square, with a margin well above
rounding, so the result is that of comparing every pair.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.geo import BOX, EARTH_RADIUS_KM, box_of, boxes_within_km, cell_label, unit_vector, within_km
from ..session import settle

_CELL = ["cell_lat", "cell_lon"]
_POINT = ["lat", "lon"]

#: bits of a position in its cell along one axis, and bits that one level of the tree reads
DEPTH, STEP = 24, 3

#: pairs of points that two squares are compared by rather than cut
FEW = 1 << 14


def _points(df: DataFrame, row_id: str, lat: str, lon: str, digits: int) -> DataFrame:
    """Distinct points with their cell and their position in it."""
    la, lo = F.col(lat).cast("double"), F.col(lon).cast("double")
    located = df.filter(la.isNotNull() & lo.isNotNull() & ~F.isnan(la) & ~F.isnan(lo)).select(
        la.alias("lat"), lo.alias("lon"), F.col(row_id).alias("__id")
    )
    points = located.groupBy(
        F.round("lat", digits).alias("cell_lat"), F.round("lon", digits).alias("cell_lon"), "lat", "lon"
    ).agg(F.min("__id").alias("first_id"), F.count(F.lit(1)).alias("n_rows"))
    fine = 1 << DEPTH
    width = 10.0**-digits

    def place(at: str, cell: str) -> Column:
        inside = F.floor((F.col(at) - F.col(cell) + width / 2) / width * fine)
        return F.least(F.greatest(inside, F.lit(0)), F.lit(fine - 1)).cast("int")

    return points.withColumns({"ix": place("lat", "cell_lat"), "iy": place("lon", "cell_lon")})


def _square(bits: int) -> Column:
    """The square a point lies in where each axis is cut into 2^bits; no bits make the cell."""
    if not bits:
        return F.lit(0).cast("long")
    along = [F.shiftright(axis, DEPTH - bits).cast("long") for axis in ("ix", "iy")]
    return F.shiftleft(along[0], DEPTH) + along[1]


def _squares(points: DataFrame, bits: int, parent_bits: int) -> DataFrame:
    """Squares with the one that contains them, their outermost points and number of points."""
    return points.groupBy(*_CELL, _square(parent_bits).alias("parent"), _square(bits).alias("square")).agg(
        *[side.alias(name) for name, side in box_of(F.col("lat"), F.col("lon")).items()],
        F.count(F.lit(1)).alias("n"),
    )


def _boxed() -> Column:
    return F.struct("square", *BOX, "n")


def _judged(pairs: DataFrame, max_km: float, level: int, few: int, carried: Sequence[str] = ()) -> DataFrame:
    """What to do with each pair of squares ``a`` and ``b``."""
    whole, any_near = boxes_within_km(
        {side: F.col(f"a.{side}") for side in BOX}, {side: F.col(f"b.{side}") for side in BOX}, max_km
    )
    at_hand = (F.col("a.n") * F.col("b.n") <= few) | F.lit(level * STEP >= DEPTH)
    verdict = F.when(whole, "whole").when(~any_near, "none").when(at_hand, "points").otherwise("cut")
    return pairs.select(
        *_CELL,
        *carried,
        F.lit(level).alias("level"),
        F.col("a.square").alias("a"),
        F.col("b.square").alias("b"),
        (F.col("a.n") * F.col("b.n")).alias("n_pairs"),
        verdict.alias("verdict"),
    ).filter(F.col("verdict") != "none")


def _stored(judged: DataFrame) -> tuple[DataFrame, int]:
    """The pairs, stored, and how many are to be cut, counted on the way."""
    seen = Observation()
    stored = settle(judged.observe(seen, F.count(F.when(F.col("verdict") == "cut", 1)).alias("n")))
    return stored, seen.get["n"]


def _tasks(df: DataFrame) -> int:
    """As many tasks as a shuffle has.

    Asked for by number where few bytes become many rows: left to itself Spark
    would take the bytes as a sign that one task is enough.
    """
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _pairs_of_parts(points: DataFrame, cut: DataFrame, level: int, carried: Sequence[str] = ()) -> DataFrame:
    """All pairs of the parts, at ``level``, of pairs of squares.

    The parts of a square are at most 64, so they travel as a list, and the pairs of
    parts of a pair come out where the pair is.
    """
    parts = _squares(points, level * STEP, (level - 1) * STEP)
    parts = parts.groupBy(*_CELL, "parent").agg(F.collect_list(_boxed()).alias("parts"))
    both = (
        cut.join(parts.withColumnsRenamed({"parent": "a", "parts": "parts_a"}), [*_CELL, "a"])
        .join(parts.withColumnsRenamed({"parent": "b", "parts": "parts_b"}), [*_CELL, "b"])
        .repartition(_tasks(points))
    )
    return both.select(*_CELL, *carried, F.explode("parts_a").alias("a"), "parts_b").select(
        *_CELL, *carried, "a", F.explode("parts_b").alias("b")
    )


def _square_pairs(points: DataFrame, max_km: float, few: int) -> tuple[DataFrame, int]:
    """Ordered pairs of squares within reach (``whole``) or to compare (``points``), and the deepest level used.

    Each level's pairs are stored; the next is laid only if some pair needs it.
    """
    boxed = _boxed()
    cells = _squares(points, 0, 0).select(*_CELL, boxed.alias("a"), boxed.alias("b"))
    judged, n_cut = _stored(_judged(cells, max_km, 0, few))
    done, deepest = judged, 0
    while n_cut:
        deepest += 1
        pairs = _pairs_of_parts(points, judged.filter("verdict = 'cut'").select(*_CELL, "a", "b"), deepest)
        judged, n_cut = _stored(_judged(pairs, max_km, deepest, few))
        done = done.unionByName(judged)
    return done.filter("verdict != 'cut'"), deepest


def _near() -> tuple[Column, Column]:
    """Columns ``at`` and ``at_b``: the points on the unit sphere."""
    at = unit_vector(F.col("lat"), F.col("lon"))
    return at.alias("at"), at.alias("at_b")


def _within(max_km: float) -> Column:
    return within_km(
        {c: F.col(c) for c in ("lat", "lon", "at")}, {c: F.col(f"{c}_b") for c in ("lat", "lon", "at")}, max_km
    )


def _in_squares(points: DataFrame, deepest: int, values: Sequence[str]) -> DataFrame:
    """Each point once for every level, with its square there."""
    levels = F.array(
        *[F.struct(F.lit(level).alias("level"), _square(level * STEP).alias("square")) for level in range(deepest + 1)]
    )
    return points.select(*_CELL, "lat", "lon", *values, F.explode(levels).alias("place")).select(
        *_CELL, "place.level", "place.square", "lat", "lon", *values
    )


def _fold(
    points: DataFrame,
    pairs: tuple[DataFrame, int],
    merges: dict[str, Column],
    max_km: float,
    made: dict[str, Column] | None = None,
) -> DataFrame:
    """For every point, ``merges`` over the points of its neighbourhood (itself included).

    ``merges`` are aggregations over the column of their own name, such that
    merging merged values is merging the parts.  Those that latitude and longitude
    alone give are in ``made``; they are worked out where points meet.

    The points of a square travel as one list for each square they are compared with, to
    where that square's points are, so what comes of a point is folded in the one task
    that has it.
    """
    square_pairs, deepest = pairs
    made = made or {}
    values = [v for v in merges if v not in made]
    merge = [how.alias(out) for out, how in merges.items()]
    placed = _in_squares(points, deepest, values)
    key = [*_CELL, "level", "square"]

    whole = square_pairs.filter("verdict = 'whole'")
    of_square = placed.withColumns(made).groupBy(*key).agg(*merge).withColumnRenamed("square", "b")
    handed = (
        whole.join(of_square, [*_CELL, "level", "b"])
        .groupBy(*_CELL, "level", F.col("a").alias("square"))
        .agg(*merge)
    )
    from_squares = placed.drop(*values).join(handed, key).select(*_CELL, "lat", "lon", *merges)

    # squares in no such pair: their points go before the joins
    compared = square_pairs.filter("verdict = 'points'").select(*_CELL, "level", "a", "b")
    taking_part = compared.select(*_CELL, "level", F.col("a").alias("square")).distinct()
    comparable = placed.join(taking_part, key, "left_semi")
    located = comparable.select(*key, "lat", "lon", unit_vector(F.col("lat"), F.col("lon")).alias("at"), *values)
    here = located.select(*_CELL, "level", F.col("square").alias("a"), "lat", "lon", "at")
    point = F.struct("lat", "lon", *[F.col(f"at.{axis}").alias(axis) for axis in "xyz"], *values)
    lists = located.groupBy(*key).agg(F.collect_list(point).alias("there")).withColumnRenamed("square", "b")
    met = compared.join(lists, [*_CELL, "level", "b"]).drop("b").join(here.hint("shuffle_hash"), [*_CELL, "level", "a"])
    both = met.select(*_CELL, "lat", "lon", "at", F.explode("there").alias("b")).select(
        *_CELL,
        "lat",
        "lon",
        "at",
        F.col("b.lat").alias("lat_b"),
        F.col("b.lon").alias("lon_b"),
        F.struct(*[F.col(f"b.{axis}").alias(axis) for axis in "xyz"]).alias("at_b"),
        *[F.col(f"b.{v}").alias(v) for v in values],
    )
    itself = (F.col("lat") == F.col("lat_b")) & (F.col("lon") == F.col("lon_b"))
    near = both.filter(_within(max_km) | itself)
    # made of the other point, before this one takes its name again
    others = near.withColumnsRenamed({"lat": "lat_a", "lon": "lon_a", "lat_b": "lat", "lon_b": "lon"}).withColumns(made)
    from_points = others.select(*_CELL, F.col("lat_a").alias("lat"), F.col("lon_a").alias("lon"), *merges)
    return from_squares.unionByName(from_points).groupBy(*_CELL, "lat", "lon").agg(*merge)


def _prepared(
    df: DataFrame, row_id: str, lat: str, lon: str, max_km: float, digits: int, few: int
) -> tuple[DataFrame, tuple[DataFrame, int]]:
    points = settle(_points(df, row_id, lat, lon, digits))
    return points, _square_pairs(points, max_km, few)


def _on_rows(df: DataFrame, per_point: DataFrame, row_id: str, lat: str, lon: str) -> DataFrame:
    """The columns computed per point, on the rows of the table."""
    keyed = df.withColumns({"lat__": F.col(lat).cast("double"), "lon__": F.col(lon).cast("double")})
    side = per_point.withColumnsRenamed({"lat": "lat__", "lon": "lon__"}).drop(*_CELL)
    return keyed.join(side, ["lat__", "lon__"], "left").drop("lat__", "lon__")


def neighbour_counts(
    df: DataFrame,
    row_id: str,
    lat: str,
    lon: str,
    max_km: float = 1.0,
    out: str = "n_neighbours",
    digits: int = 2,
    few: int = FEW,
) -> DataFrame:
    """How many other rows of its cell lie within ``max_km`` of each row."""
    points, pairs = _prepared(df, row_id, lat, lon, max_km, digits, few)
    counted = _fold(points, pairs, {"n_rows": F.sum("n_rows")}, max_km)
    joined = _on_rows(df, counted, row_id, lat, lon)
    return joined.withColumn(out, F.coalesce(F.col("n_rows") - 1, F.lit(0))).select(*df.columns, out)


def _common_ids(points: DataFrame, pairs: tuple[DataFrame, int], max_km: float) -> DataFrame:
    """The id of each point by the rule of neighbourhoods, as ``__common``."""
    # fold 1: smallest id, and what identifies the set of members
    marked = points.withColumn("lowest", F.col("first_id"))
    made = {
        "mark1": F.xxhash64(F.lit(1), "lat", "lon"),
        "mark2": F.xxhash64(F.lit(2), "lon", "lat"),
        "members": F.lit(1).cast("long"),
    }
    merges = {
        "lowest": F.min("lowest"),
        "mark1": F.bit_xor("mark1"),
        "mark2": F.bit_xor("mark2"),
        "members": F.sum("members"),
    }
    same_set = [*_CELL, "mark1", "mark2", "members", "lowest"]
    hoods = _fold(marked, pairs, merges, max_km, made)
    hoods = settle(hoods.join(points, [*_CELL, "lat", "lon"]))
    pos = hoods.groupBy(*same_set).agg(F.min("first_id").alias("pos"))

    # fold 2: the member whose neighbourhood comes last decides; pos names its neighbourhood
    placed = hoods.join(pos, same_set).select(*_CELL, "lat", "lon", "ix", "iy", "pos")
    last = _fold(placed, pairs, {"pos": F.max("pos")}, max_km)
    lowest = pos.select("pos", F.col("lowest").alias("__common"))
    return last.join(lowest, ["pos"]).select(*_CELL, "lat", "lon", "__common")


# --- components ------------------------------------------------------------------------


def _tile_bits(max_km: float, digits: int) -> int:
    """Cuts of a cell after which a tile's diagonal is surely within reach, at any latitude."""
    across = math.radians(10.0**-digits) * EARTH_RADIUS_KM * math.sqrt(2) * 1.01
    bits = max(0, math.ceil(math.log2(across / max_km)))
    if bits > DEPTH:
        raise ValueError(f"a reach of {max_km} km is too short: a cell has 2^{DEPTH} positions along an axis")
    return bits


def _neighbour_tiles(tiles: DataFrame, max_km: float, digits: int, bits: int) -> DataFrame:
    """Pairs of tiles of a cell, the smaller first, that may have points within reach; by equal positions, not by pairs."""
    width = math.radians(10.0**-digits) * EARTH_RADIUS_KM / (1 << bits)
    most = (1 << bits) - 1
    # cells are narrower towards the poles
    far_x = F.lit(min(math.ceil(max_km / width) + 1, most))
    far_y = F.least(F.ceil(max_km / (width * F.greatest("cos_low", F.lit(1e-9)))) + 1, F.lit(most))
    x, y = F.shiftright("square", DEPTH), F.col("square").bitwiseAND(F.lit((1 << DEPTH) - 1).cast("long"))
    boxed = _boxed()
    here = (
        tiles.select(*_CELL, boxed.alias("a"), x.alias("x"), y.alias("y"), far_x.alias("far_x"), far_y.alias("far_y"))
        .withColumn("dx", F.explode(F.sequence(F.lit(0).cast("long"), F.col("far_x").cast("long"))))
        .withColumn("dy", F.explode(F.sequence(-F.col("far_y").cast("long"), F.col("far_y").cast("long"))))
        .filter((F.col("dx") > 0) | (F.col("dy") > 0))
        .select(*_CELL, "a", (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"))
    )
    there = tiles.select(*_CELL, x.alias("x"), y.alias("y"), boxed.alias("b"))
    return here.join(there, [*_CELL, "x", "y"]).drop("x", "y")


def _tile_links(points: DataFrame, max_km: float, digits: int, few: int) -> DataFrame:
    """Pairs of tiles of which any two points are within reach.

    A pair is left at the first two squares wholly within reach.  Squares below a
    tile are numbered at levels of the tree, so the first cut goes to the next level.
    """
    bits = _tile_bits(max_km, digits)
    root = ["tile_a", "tile_b"]
    tiles = _squares(points, bits, 0)
    pairs = _neighbour_tiles(tiles, max_km, digits, bits).withColumns({"tile_a": F.col("a.square"), "tile_b": F.col("b.square")})
    judged, n_cut = _stored(_judged(pairs, max_km, bits // STEP, few, root))
    tile = [*_CELL, *root]
    linked = judged.filter("verdict = 'whole'").select(*tile)
    compared = judged.filter("verdict = 'points'").select(*tile, F.lit(bits).alias("bits"), "a", "b")
    at = bits
    while n_cut:
        below = min((at // STEP + 1) * STEP, DEPTH)
        parts = _squares(points, below, at).groupBy(*_CELL, "parent").agg(F.collect_list(_boxed()).alias("parts"))
        # a tile pair with a hit among its squares needs no more
        cut = judged.filter("verdict = 'cut'").join(judged.filter("verdict = 'whole'").select(*tile).distinct(), tile, "left_anti")
        both = (
            cut.select(*tile, "a", "b")
            .join(parts.withColumnsRenamed({"parent": "a", "parts": "parts_a"}), [*_CELL, "a"])
            .join(parts.withColumnsRenamed({"parent": "b", "parts": "parts_b"}), [*_CELL, "b"])
            .repartition(_tasks(points))
        )
        pairs = both.select(*tile, F.explode("parts_a").alias("a"), "parts_b").select(*tile, "a", F.explode("parts_b").alias("b"))
        judged, n_cut = _stored(_judged(pairs, max_km, below // STEP, few, root))
        linked = linked.unionByName(judged.filter("verdict = 'whole'").select(*tile))
        compared = compared.unionByName(judged.filter("verdict = 'points'").select(*tile, F.lit(below).alias("bits"), "a", "b"))
        at = below
    return linked.unionByName(_tested(points, compared.join(linked.distinct(), tile, "left_anti"), max_km, tile)).distinct()


def _tested(points: DataFrame, compared: DataFrame, max_km: float, tile: Sequence[str]) -> DataFrame:
    """Of pairs of squares to compare, the tiles of those with two points within reach."""
    depths = [r.bits for r in compared.select("bits").distinct().collect()]  # as many as the tree has levels
    if not depths:
        return compared.select(*tile)
    levels = F.array(*[F.struct(F.lit(bits).alias("bits"), _square(bits).alias("square")) for bits in depths])
    wanted = compared.select(*_CELL, "bits", F.explode(F.array("a", "b")).alias("square")).distinct()
    placed = points.select(*_CELL, "lat", "lon", F.explode(levels).alias("place")).select(*_CELL, "place.bits", "place.square", "lat", "lon")
    placed = placed.join(wanted, [*_CELL, "bits", "square"], "left_semi")
    at, at_b = _near()
    here = placed.select(*_CELL, "bits", F.col("square").alias("a"), "lat", "lon", at)
    there = placed.select(*_CELL, "bits", F.col("square").alias("b"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), at_b)
    met = compared.join(here, [*_CELL, "bits", "a"]).join(there, [*_CELL, "bits", "b"])
    return met.filter(_within(max_km)).select(*tile)


def _smallest_reached(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """For every node (id) the smallest id that it reaches over links (u, v), as ``least``.

    Each round a node takes the smallest id among its own and its neighbours' and then
    what the node of that id has; the rounds a chain needs grow with its logarithm.
    """
    both = settle(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels, changed = settle(nodes.select("id", F.col("id").alias("least"))), 1
    while changed:
        offered = both.join(labels, F.col("v") == F.col("id")).groupBy("u").agg(F.min("least").alias("offer"))
        hooked = labels.join(offered, F.col("id") == F.col("u"), "left").select("id", "least", F.least("least", F.coalesce("offer", "least")).alias("next"))
        # the node that a label names hands on its own
        named = hooked.select(F.col("id").alias("next"), F.col("next").alias("onward"))
        jumped = hooked.join(named, "next").select("id", F.least("next", "onward").alias("to"), "least")
        seen = Observation()
        moved = settle(jumped.observe(seen, F.count(F.when(F.col("to") != F.col("least"), 1)).alias("n")))
        labels, changed = moved.select("id", F.col("to").alias("least")), seen.get["n"]
    return labels


def _component_ids(points: DataFrame, max_km: float, digits: int, few: int) -> DataFrame:
    """The smallest id of each point's component, as ``__common``."""
    tile = _square(_tile_bits(max_km, digits))
    tiles = settle(points.groupBy(*_CELL, tile.alias("tile")).agg(F.min("first_id").alias("id")))
    links = _tile_links(points, max_km, digits, few)
    for end, name in (("tile_a", "u"), ("tile_b", "v")):
        links = links.join(tiles.withColumnsRenamed({"tile": end, "id": name}), [*_CELL, end])
    reached = _smallest_reached(tiles.select("id"), links)
    named = tiles.join(reached, "id").select(*_CELL, "tile", F.col("least").alias("__common"))
    return points.select(*_CELL, "lat", "lon", tile.alias("tile")).join(named, [*_CELL, "tile"]).drop("tile")


def near_duplicate_ids(
    df: DataFrame,
    row_id: str,
    lat: str,
    lon: str,
    max_km: float = 1.0,
    out: str = "infrastructure_id",
    cell: str | None = "column_localite",
    digits: int = 2,
    few: int = FEW,
    mode: str = "neighbourhoods",
) -> DataFrame:
    """Adds the common id of near duplicates, and the name of the rounded cell.

    ``row_id`` is any unique, orderable column; rows without a full point keep
    their own.  ``mode``: ``neighbourhoods`` is the rule above, ``components`` gives
    all rows that neighbours of neighbours connect the smallest id among them.
    """
    if mode == "components":
        ids = _component_ids(settle(_points(df, row_id, lat, lon, digits)), max_km, digits, few)
    elif mode == "neighbourhoods":
        ids = _common_ids(*_prepared(df, row_id, lat, lon, max_km, digits, few), max_km)
    else:
        raise ValueError("mode is neighbourhoods or components")
    joined = _on_rows(df, ids, row_id, lat, lon).withColumn(out, F.coalesce("__common", F.col(row_id)))
    if cell:
        joined = joined.withColumn(cell, cell_label(F.col(lat), F.col(lon), digits))
    return joined.drop("__common").select(*df.columns, out, *([cell] if cell else []))
