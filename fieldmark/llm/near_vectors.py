"""Embedding near-dedup: an exact metric range join of unit vectors.

Cosine c of unit vectors is a distance of sqrt(2 - 2 c), so "cosine at least c" is a
range join.  Pivots partition the vectors of a label into cells, each vector to its
nearest pivot.  A vector also visits every other cell that could hold a neighbour: by
the triangle inequality only if that pivot is farther by at most twice the range, and,
as distances are Euclidean, only if the plane between the two pivots is in range.  Then
cells join independently: the vectors that live in a cell, in blocks of fixed size, meet
all that live there or visit.

Equal vectors are folded into one with a count first.  A block gives a count per vector
and enough links to connect what is connected, not all of its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.session import settle

from .components import components

#: Vectors that a cell should hold; the fewest pivots of a label, and the most of all labels together.
CELL, LEAST, PIVOTS = 8192, 4, 2048
#: Vectors of a cell that one block holds, and the side of the tiles they are compared in.
BLOCK, TILE = 4096, 1024

_CELLS = "label bigint, dim int, pivot int, lives boolean, rep bigint, hash bigint, n bigint, vec array<{kind}>"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _cell_rows(pivots: dict[tuple[int | None, int], np.ndarray], least: float) -> Callable:
    """Each vector where it lives and where it visits."""
    reach = float(np.sqrt(2 - 2 * least)) * (1 + 1e-9) + 1e-9

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
            for key in sorted(set(zip(label.tolist(), dim.tolist(), strict=True))):
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                for begin in range(0, len(at), TILE):
                    some = batch.take(pa.array(at[begin : begin + TILE]))
                    points, centres = _unit(_matrix(some.column("vec"))), pivots.get(key, pivots.get((None, key[1])))
                    if centres is None:
                        row, cell, home = np.arange(len(points)), np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
                    else:
                        square = np.maximum(2 - 2 * points @ centres.T, 0)
                        home = square.argmin(axis=1)
                        away, near = np.sqrt(square), square[np.arange(len(points)), home]
                        between = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))[home]
                        visits = (away <= np.sqrt(near)[:, None] + 2 * reach) & (square - near[:, None] <= 2 * reach * between + 1e-9)
                        visits[np.arange(len(points)), home] = True
                        row, cell = np.nonzero(visits)
                    taken = some.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [
                            taken.column("label"), taken.column("dim"), pa.array(cell.astype(np.int32)), pa.array(home[row] == cell),
                            taken.column("rep"), taken.column("hash"), taken.column("n"), taken.column("vec"),
                        ],
                        ["label", "dim", "pivot", "lives", "rep", "hash", "n", "vec"],
                    )

    return rows


def _connect(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and column of a table of links, the first row that it is connected with, or -1."""
    big = np.iinfo(np.int64).max
    row = np.where(close.any(axis=1), np.arange(close.shape[0]), big)
    while True:
        column = np.where(close, row[:, None], big).min(axis=0)
        new = np.where(close, column[None, :], big).min(axis=1)
        if (new == row).all():
            return np.where(row == big, -1, row), np.where(column == big, -1, column)
        row = new


def _link_rows(least: float) -> Callable:
    """Per block: (id, hash, links) of each vector that lives there, and (id, other) that connect."""
    names = ["rep", "hash", "links", "other"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in ("label", "dim", "pivot", "block")]
            change = np.zeros(batch.num_rows, bool)
            change[0] = True
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(change)
            for a, b in zip(at.tolist(), [*at[1:].tolist(), batch.num_rows], strict=True):
                here = tuple(int(c[a]) for c in columns)
                if here != key:
                    yield from finish(parts)
                    key, parts = here, []
                piece = batch.slice(a, b - a)
                own = piece.column("own").to_numpy(zero_copy_only=False)
                if own.any():
                    parts.append(block_of(piece.filter(pa.array(own))))
                if not own.all():
                    # vectors of the block come first, so it is complete now
                    parts = [merged(parts)]
                    yield from compare(parts[0], block_of(piece.filter(pa.array(~own))))
        yield from finish(parts)

    def block_of(piece: pa.RecordBatch) -> dict:
        vectors = _matrix(piece.column("vec"))
        return {
            "vec": vectors, "norm": np.linalg.norm(vectors, axis=1), "links": np.zeros(len(vectors), np.int64),
            **{c: piece.column(c).to_numpy() for c in ("rep", "hash", "n")},
        }

    def merged(parts: list[dict]) -> dict:
        return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}

    def compare(own: dict, met: dict) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(own["rep"]), TILE):
            x = slice(i, i + TILE)
            for j in range(0, len(met["rep"]), TILE):
                y = slice(j, j + TILE)
                close = own["vec"][x] @ met["vec"][y].T / (own["norm"][x][:, None] * met["norm"][y][None, :]) >= least
                close &= (own["rep"][x][:, None] != met["rep"][y][None, :]) | (own["hash"][x][:, None] != met["hash"][y][None, :])
                some, few = close.any(axis=1), close.any(axis=0)
                if not some.any():
                    continue
                own["links"][x] += close @ met["n"][y]
                row, column = _connect(close[some][:, few])
                ids = own["rep"][x][some]
                one, two = np.concatenate([ids, met["rep"][y][few]]), ids[np.concatenate([row, column])]
                apart = one != two
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[apart]), pa.nulls(int(apart.sum()), pa.int64()), pa.nulls(int(apart.sum()), pa.int64()), pa.array(two[apart])], names
                )

    def finish(parts: list[dict]) -> Iterator[pa.RecordBatch]:
        if parts:
            own = merged(parts)
            linked = own["links"] > 0
            n = int(linked.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(own["rep"][linked]), pa.array(own["hash"][linked]), pa.array(own["links"][linked]), pa.nulls(n, pa.int64())], names
            )

    return rows


def _pivots(classes: DataFrame) -> dict[tuple[int | None, int], np.ndarray]:
    """Pivots by label and length, vectors of smallest hash: one for ``CELL`` vectors, but ``LEAST`` at least.

    The largest labels have their own, up to ``PIVOTS`` in all; the others, where there are
    so many labels, share some of the same length, under the label None.  Any vectors
    do as pivots, so this decides only how cells come out.  Two jobs, whatever the number of labels.
    """
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    most = PIVOTS // LEAST
    told = sizes.orderBy(F.desc("size"), "label", "dim").limit(most).toPandas()  # bounded
    told["wanted"] = np.maximum(LEAST, -(-told["size"] // CELL))
    shrink = min(1.0, PIVOTS / max(1, int(told["wanted"].sum())))
    told["wanted"] = np.maximum(LEAST, (told["wanted"] * shrink).astype(int))
    if not len(told):
        return {}
    # a sample by hash that surely holds as many, of which a window takes the first
    chosen = classes.sparkSession.createDataFrame(told[["label", "dim", "size", "wanted"]], "label bigint, dim int, size bigint, wanted bigint")
    luck = F.pmod(F.xxhash64("hash", "rep"), F.lit(1 << 30)) / float(1 << 30)
    sample = classes.join(F.broadcast(chosen), ["label", "dim"]).where(luck * F.col("size") <= 8 * F.col("wanted"))
    place = F.row_number().over(Window.partitionBy("label", "dim").orderBy(F.xxhash64("hash"), "rep"))
    picked = sample.withColumn("place", place).where("place <= wanted").select("label", "dim", "vec").toArrow()  # PIVOTS rows at most, or LEAST a label
    label, dim = picked["label"].to_numpy(), picked["dim"].to_numpy()
    pivots: dict[tuple[int | None, int], np.ndarray] = {}
    for key in sorted(set(zip(label.tolist(), dim.tolist(), strict=True))):
        own = picked.filter(pa.array((label == key[0]) & (dim == key[1])))
        pivots[key] = _unit(_matrix(own["vec"].combine_chunks()))
        pivots.setdefault((None, key[1]), pivots[key][:LEAST])
    return pivots


def near_vectors(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Two vectors of one label link when their cosine, in double precision, is at least
    ``least``; a component is named by its smallest id, whose vector is kept.

    Defined cases.  A vector that is null, empty, zero or holds a null or a number that is
    not finite links with nothing, as does one whose label or id is null.  Vectors of
    different lengths do not link.  Rows that repeat an id are one node among components,
    and each counts its own links.  A row with a null id is kept.
    """
    # single precision stays as it is, anything else is taken in double precision
    kind = "float" if dict(vectors.dtypes)[vec_col] == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("vec"), F.col(label_col).cast("bigint").alias("label"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(~bad & F.exists("vec", lambda x: x != 0), F.lit(False))
    classes = settle(
        rows.where(fine).groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
        .withColumns({"dim": F.size("vec"), "hash": F.xxhash64("label", "vec")})
    )

    pivots = _pivots(classes)
    keys = ["label", "dim", "pivot"]
    cells = classes.select("label", "dim", "rep", "hash", "n", "vec").mapInArrow(_cell_rows(pivots, least), _CELLS.format(kind=kind))
    cells = settle(cells)
    blocks = cells.where("lives").groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = cells.join(blocks, keys).withColumn("home", F.pmod(F.col("hash"), F.col("blocks")).cast("int"))
    asked = placed.withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "own": F.lit(False)})
    own = placed.where("lives").withColumns({"block": F.col("home"), "own": F.lit(True)})
    together = own.unionByName(asked).drop("lives", "blocks", "home")
    found = settle(
        # by number: Spark would put blocks together by their bytes, not by their work
        together.repartition(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "block").sortWithinPartitions(*keys, "block", F.desc("own"))
        .mapInArrow(_link_rows(least), "rep bigint, hash bigint, links bigint, other bigint")
    )
    merged = components(found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    links = found.where("links is not null").groupBy("rep", "hash").agg(F.sum("links").alias("links"))
    judged = (
        classes.select("label", "vec", "rep", "hash", "n")
        .join(links, ["rep", "hash"], "left")
        .join(merged.withColumnRenamed("id", "rep"), "rep", "left")
        .select("label", "vec", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    joined = rows.join(judged.withColumn("here", F.lit(True)), ["label", "vec"], "left")
    linked = F.col("here") & F.col("id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(linked, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
