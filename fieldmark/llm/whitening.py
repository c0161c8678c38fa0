"""Embedding whitening with a weighted covariance over distinct vectors.

Vectors become whole numbers, x = floor(scale * c) + shift, and rows of equal x are one
distinct vector with a count.  The fit weighs a distinct vector by its count, which is the
fit over all rows, or by one.  Three steps run on the distinct vectors alone:

1. sums per dimension, exact, as whole numbers;
2. a weighted product of centred blocks, (x - mean)' diag(weight) (x - mean), one matrix per
   task, added entry by entry in a shuffle;
3. projection on the leading eigenvectors of that covariance, over the root of the eigenvalue.

Only sums and the covariance of one vector length, d and d * d numbers, reach the driver.
Then rows take the result of their distinct vector.  Vectors that hold at least a
``HOT``-th of all rows are at most ``HOT`` and are broadcast, so no task gets the rows
of a large group of copies; the others join by a 128-bit hash of x, which is checked to be
unique among distinct vectors.

Defined cases: null vectors, and vectors with null or non-finite entries, take no part and
give no rows; so do empty vectors, which have no components.  Vectors of different
lengths are tables of their own: each length has its own n, sums and components.  Entries
beyond the range of a long go to its end.  A component without variance (eigenvalue not above
rounding) has null ``whitened``; ``explained`` is null where nothing varies; a deviation of
more than 38 digits is null.  Repeated and null ids are rows like any other; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.session import settle

#: Rows of one distinct vector are hot from this share of all rows on: one in so many.
HOT = 1024
#: Entries of one block of a product.
BLOCK = 1 << 20
#: Magnitude up to which whole numbers and n times their distance from the mean stay exact in 64 bits.
_SAFE = 1 << 62

_WIDE = Context(prec=60)
_EXACT = "decimal(38,0)"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """Vectors of one length, one in a row."""
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _of_one_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches recut so that all vectors of one have the same length."""
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims).tolist():
            own = batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))
            step = max(1, BLOCK // dim)
            for at in range(0, own.num_rows, step):
                yield dim, own.slice(at, step)


def _exact(value: int) -> Decimal | None:
    """The number as a decimal; null beyond 38 digits."""
    return _WIDE.create_decimal(value) if abs(value) < 10**38 else None


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length, the weights and the weighted sums of x; row -1 holds the weights."""
    sums: dict[int, list[int]] = {}
    for dim, own in _of_one_length(batches):
        x, weight = _matrix(own), own.column("weight").to_numpy()
        low = x.min(axis=0)
        reach = max(abs(int(x.min())), int(x.max()))
        if reach * int(weight.sum()) < _SAFE:
            part = [int(v) for v in (x * weight[:, None]).sum(axis=0)]
        else:
            part = [int(v) for v in ((x.astype(object) - low.astype(object)) * weight[:, None]).sum(axis=0) + low.astype(object) * int(weight.sum())]
        held = sums.setdefault(dim, [0] * (dim + 1))
        for k, value in enumerate([int(weight.sum()), *part]):
            held[k] += value
    for dim, held in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * len(held), pa.int32()), pa.array(range(-1, dim), pa.int32()), pa.array([_exact(v) for v in held], pa.decimal128(38, 0))],
            ["dim", "at", "total"],
        )


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact; as Python's whole numbers where 64 bits do not hold them."""
    reach = max(abs(int(x.min())), int(x.max()))
    if (reach * n + max(map(abs, sums))) < _SAFE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _product_rows(fits: dict[int, tuple[int, list[int]]]) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[int, np.ndarray] = {}
        for dim, own in _of_one_length(batches):
            n, sums = fits[dim]
            centred = _centred(_matrix(own), n, sums).astype(np.float64) / n
            weight = own.column("weight").to_numpy().astype(np.float64)
            product = centred.T @ (centred * weight[:, None])
            products[dim] = products[dim] + product if dim in products else product
        for dim, product in products.items():
            upper = np.triu_indices(dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(upper[0]), dim, np.int32)), pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(product[upper])],
                ["dim", "i", "j", "value"],
            )

    return rows


def _squares(distance: np.ndarray) -> list[Decimal | None]:
    """Exact sums of squares of each row."""
    if distance.dtype == object:
        return [_exact(int((row * row).sum())) for row in distance]
    high, low = distance >> 24, distance & 0xFFFFFF
    if int(np.abs(high).max(initial=0)) >= 1 << 28 or distance.shape[1] >= 1 << 6 + 9:
        return [_exact(sum(v * v for v in row)) for row in distance.tolist()]
    a, b, c = (high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)
    return [_exact((p << 48) + (q << 25) + r) for p, q, r in zip(a.tolist(), b.tolist(), c.tolist(), strict=True)]


def _whitened_rows(fits: dict[int, tuple[int, list[int]]], maps: dict[int, np.ndarray]) -> Callable:
    """Deviation and whitened components of each distinct vector."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, own in _of_one_length(batches):
            n, sums = fits[dim]
            distance = _centred(_matrix(own), n, sums)
            made = (distance.astype(np.float64) / n) @ maps[dim]
            flat = pa.array(made.ravel(), from_pandas=True)  # a component without variance is null
            bounds = pa.array(np.arange(len(made) + 1, dtype=np.int32) * made.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    own.column("dim"), own.column("key1"), own.column("key2"), own.column("rows"), own.column("weight"),
                    pa.array(_squares(distance), pa.decimal128(38, 0)), pa.ListArray.from_arrays(bounds, flat),
                ],
                ["dim", "key1", "key2", "rows", "weight", "deviation", "whitened"],
            )

    return rows


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues and unit eigenvectors (columns), by falling eigenvalue; the entry of largest size is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    strongest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[strongest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def _identity_errors(white: DataFrame, varying: dict[int, int]) -> dict[int, float]:
    """Per length, the largest entry of the whitened vectors' covariance minus the identity."""
    errors = {}
    for dim, k in varying.items():
        if not k:
            errors[dim] = None
            continue
        own, w = white.where(F.col("dim") == dim), F.col("weight").cast("double")
        part = [F.col("whitened")[i] for i in range(k)]
        first = own.agg(F.sum(w).alias("n"), *[F.sum(w * p).alias(f"m{i}") for i, p in enumerate(part)]).first()
        away = [p - first[f"m{i}"] / first["n"] for i, p in enumerate(part)]
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        products = own.agg(*[F.sum(w * away[i] * away[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
        errors[dim] = max(abs(products[f"p{i}_{j}"] / first["n"] - (i == j)) for i, j in pairs)
    return errors


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame:
    """(id, dim, x) of the vectors that take part; x are whole numbers."""
    entries = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.where(F.col(f"`{vec_col}`").isNotNull() & (F.size(entries) > 0) & finite)
    # beyond 2^62 a long ends; least and greatest keep the cast from failing
    whole = F.transform(entries, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(2.0**62)), F.lit(-(2.0**62)))).cast("long") + shift)
    return kept.select(F.col(f"`{id_col}`").alias("id"), F.size(entries).alias("dim"), whole.alias("x"))


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = 8,
    weights: str = "counts",
    scale: int = 1024,
    shift: int = 100000,
) -> DataFrame:
    """(id, dim, n, deviation, whitened, explained, identity_error) of every vector that takes part.

    ``whitened`` and ``explained`` are arrays over the components, up to ``components``;
    ``deviation`` is the exact sum of (n x - S)^2 over dimensions, a decimal.  ``weights``:
    ``counts`` fits over all rows, ``one`` over distinct vectors; n and S are those of the fit.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_col, vec_col, scale, shift)
    keys = {"key1": F.xxhash64("x"), "key2": F.xxhash64(F.lit(1), "x")}
    counted = rows.groupBy("dim", "x").agg(F.count(F.lit(1)).alias("rows"))
    weight = F.col("rows") if weights == "counts" else F.lit(1).cast("long")
    distinct = settle(counted.withColumns({**keys, "weight": weight}))
    if not distinct.groupBy("key1", "key2").count().where("count > 1").isEmpty():
        raise RuntimeError("two vectors share a hash of 128 bits")

    schema = f"dim int, at int, total {_EXACT}"
    totals = distinct.select("dim", "x", "weight").mapInArrow(_sum_rows, schema).groupBy("dim", "at").agg(F.sum("total").cast(_EXACT).alias("total")).collect()
    held: dict[int, dict[int, int]] = {}
    for r in totals:
        held.setdefault(r.dim, {})[r.at] = int(r.total)
    fits = {dim: (own[-1], [own[k] for k in range(dim)]) for dim, own in held.items()}

    products = distinct.select("dim", "x", "weight").mapInArrow(_product_rows(fits), "dim int, i int, j int, value double")
    covariances = {dim: np.zeros((dim, dim)) for dim in fits}
    for r in products.groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).collect():
        covariances[r.dim][r.i, r.j] = covariances[r.dim][r.j, r.i] = r.value / fits[r.dim][0]

    maps, explained, varying = {}, {}, {}
    for dim, covariance in covariances.items():
        values, axes = components_of(covariance, components)
        trace = float(np.trace(covariance))
        varies = values > max(trace, 0.0) * dim * np.finfo(float).eps
        maps[dim] = axes / np.where(varies, np.sqrt(np.where(varies, values, 1.0)), np.nan)
        explained[dim] = [float(v) / trace if trace > 0 else None for v in values]
        varying[dim] = int(varies.sum())

    kind = f"dim int, key1 bigint, key2 bigint, rows bigint, weight bigint, deviation {_EXACT}, whitened array<double>"
    white = settle(distinct.mapInArrow(_whitened_rows(fits, maps), kind))
    errors = _identity_errors(white, varying)
    n_rows = int(white.agg(F.sum("rows")).first()[0] or 0)

    keyed = rows.select("id", "dim", *[how.alias(name) for name, how in keys.items()])
    on = ["dim", "key1", "key2"]
    result = white.select(*on, "rows", "deviation", "whitened")
    hot, cold = result.where(F.col("rows") * HOT >= n_rows), result.where(F.col("rows") * HOT < n_rows)
    joined = keyed.join(F.broadcast(hot), on).unionByName(keyed.join(F.broadcast(hot.select(on)), on, "left_anti").join(cold, on))
    per_dim = spark.createDataFrame(
        [(dim, fits[dim][0], explained[dim], errors[dim]) for dim in fits], "dim int, n bigint, explained array<double>, identity_error double"
    )
    # one row for each length of vector: as small as the fits that the driver holds
    finished = joined.join(F.broadcast(per_dim), "dim")
    return finished.select(F.col("id").alias(id_col), "dim", "n", "deviation", "whitened", "explained", "identity_error")


def by_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row for each vector and component, numbered from 1; ``deviation`` as a long, null beyond its range."""
    return whitened.select(
        id_col, "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part"),
    ).select(
        id_col, (F.col("at") + 1).alias("component"), "n", "deviation", F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"), "identity_error",
    )
