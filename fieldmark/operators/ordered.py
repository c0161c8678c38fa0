"""Operators on rows in order: running sums, forward fill, previous row, counters.

A plain window gives one task all rows of a key.  Here a key may hold any share
of the table, and there may be no key at all: rows are cut into blocks, consecutive
in the order, and a window only ever sees one block of one key.  What a block needs
to know of the blocks before it is one row, its *seed*, placed in front of its rows:

1. each block is summarised (a sum, its last row, its last non-null value) by an
   ordinary aggregation, which combines before it shuffles;
2. summaries are folded again over ``FAN`` consecutive blocks, so that the top of
   this tree has one row for ``FAN`` blocks; a window over the top gives each of
   its nodes what came before, which goes down in front of the node's blocks;
3. seeds and rows go through one window partitioned by key and block.

So a window sees rows of one block, summaries of one node, or the top.

``block`` is one or more columns that never decrease along the order within a
key; the last one is a whole number, such as ``blocks_of(position)`` or an hour, those
before it, if any, are few.  ``order`` must be total within a key, or ties fall
either way.  Null keys form one group.

Sums of floating-point values are exact until they are finished (see
``functions.exact``): the result does not depend on how blocks are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.exact import is_floating, joined, part_names, parts_of

_SEED = "__seed"
_HEAD = "__head"
_BLOCK = "__block"
_NODE = "__node"

BLOCK_ROWS = 65536
#: Blocks, or nodes, that one node of the tree folds, as a power of two; one entry for each level.
FAN = (12,)


def blocks_of(position: Column, rows: int = BLOCK_ROWS) -> Column:
    """Block number of an integer position."""
    return F.floor(position / rows)


def block_of_time(time: Column, seconds: int) -> Column:
    """Block number of a date or timestamp: spans of so many seconds."""
    return F.floor(F.unix_seconds(time.cast("timestamp")) / seconds)


def _with_block(df: DataFrame, block: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    """The rows with their block, and the columns that name it."""
    heads = {f"{_HEAD}{i}": b for i, b in enumerate(block[:-1])}
    return df.withColumns({**heads, _BLOCK: block[-1].cast("long")}), [*heads, _BLOCK]


def _last(column: str, order: Column) -> Column:
    """The last value that is not null."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), order)).alias(column)


def _before(
    blocks: DataFrame, keys: Sequence[str], at: Sequence[str], sums: Sequence[str], lasts: Sequence[str], fan: Sequence[int] = FAN
) -> DataFrame:
    """For every block the sums and the last values over all blocks of its key before it."""
    heads = [c for c in at if c != _BLOCK]
    levels = [blocks]
    for bits in fan:
        child = F.struct(F.col(_BLOCK))
        folded = [F.sum(c).alias(c) for c in sums] + [_last(c, child) for c in lasts]
        nodes = levels[-1].withColumn(_NODE, F.shiftright(_BLOCK, bits)).groupBy(*keys, *heads, _NODE).agg(*folded)
        levels.append(nodes.withColumnRenamed(_NODE, _BLOCK))

    def earlier(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(Window.unboundedPreceding, -1)
        return {c: F.sum(c).over(frame) for c in sums} | {c: F.last(c, ignorenulls=True).over(frame) for c in lasts}

    # block numbers have fewer than 62 bits, so all nodes have one root
    root = F.shiftright(F.col(_BLOCK) + (1 << 61), 62)
    top = levels[-1].withColumn(_NODE, root)
    seeds = top.withColumns(earlier(Window.partitionBy(*keys, _NODE).orderBy(*at))).drop(_NODE)
    for nodes, bits in zip(levels[-2::-1], fan[::-1], strict=True):
        children = nodes.withColumns({_NODE: F.shiftright(_BLOCK, bits), _SEED: F.lit(1)})
        parents = seeds.withColumnRenamed(_BLOCK, _NODE).withColumn(_SEED, F.lit(0))
        both = children.unionByName(parents, allowMissingColumns=True)
        window = Window.partitionBy(*keys, *heads, _NODE).orderBy(_SEED, _BLOCK)
        seeds = both.withColumns(earlier(window)).filter(F.col(_SEED) == 1).drop(_NODE, _SEED)
    return seeds


def _seeded(rows: DataFrame, seeds: DataFrame, keys: Sequence[str], at: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, WindowSpec]:
    """Rows with their seed rows in front, and the window over one block of one key."""
    both = rows.withColumn(_SEED, F.lit(1)).unionByName(
        seeds.withColumn(_SEED, F.lit(0)), allowMissingColumns=True
    )
    window = Window.partitionBy(*keys, *at).orderBy(_SEED, *order)
    return both, window


def _finish(both: DataFrame, columns: Sequence[str], added: Sequence[str]) -> DataFrame:
    kept = [c for c in columns if c not in added]
    return both.filter(F.col(_SEED) == 1).select(*kept, *added)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    block: Sequence[Column],
) -> DataFrame:
    """Running sums row by row within each key, nulls counting as zero.

    Sums of floating-point values are split into limbs, all others added as they are.
    """
    floating = {out: F.coalesce(value, F.lit(0.0)) for out, value in sums.items() if is_floating(df, value)}
    whole = {f"__{out}": F.coalesce(value, F.lit(0)) for out, value in sums.items() if out not in floating}
    added = [*whole, *[name for out in floating for name in part_names(out)]]
    rows, at = _with_block(df, block)
    plain = {f"__{out}": value.cast("double") for out, value in floating.items()}
    limbs = {name: F.expr(part) for out in floating for name, part in parts_of(out, f"__{out}").items()}
    rows = rows.withColumns(whole | plain).withColumns(limbs).drop(*plain)
    totals = rows.groupBy(*keys, *at).agg(*[F.sum(c).alias(c) for c in added])
    both, window = _seeded(rows, _before(totals, keys, at, added, []), keys, at, order)
    frame = window.rowsBetween(Window.unboundedPreceding, 0)
    made = {out: joined(out) if out in floating else F.col(f"__{out}") for out in sums}
    both = both.withColumns({c: F.sum(c).over(frame) for c in added}).withColumns(made)
    return _finish(both, df.columns, list(sums))


def row_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, block: Sequence[Column]
) -> DataFrame:
    """Position of each row in the order, from 0."""
    counted = running_sum(df, keys, order, {out: F.lit(1).cast("long")}, block)
    return counted.withColumn(out, F.col(out) - 1)


def carry(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Sequence[Column],
    fill: Sequence[str] = (),
    previous: dict[str, str] | None = None,
) -> DataFrame:
    """What rows take over from the rows before them within the key, in one pass.

    Nulls in the ``fill`` columns become the last non-null value so far;
    ``previous`` adds columns with a value of the row just before (result: source).
    """
    previous = previous or {}
    rows, at = _with_block(df, block)
    # a row's value travels in a struct: the last struct is that of the last row, be its value null
    rows = rows.withColumns({f"__{out}": F.struct(F.col(src).alias("value")) for out, src in previous.items()})
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    taken = [f"__{out}" for out in previous]
    last_row = [F.max_by(c, position).alias(c) for c in taken]
    tails = rows.groupBy(*keys, *at).agg(*[_last(c, position) for c in fill], *last_row)
    both, window = _seeded(rows, _before(tails, keys, at, [], [*fill, *taken]), keys, at, order)
    frame = window.rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumns(
        {c: F.last(c, ignorenulls=True).over(frame) for c in fill}
        | {out: F.lag(f"__{out}").over(window)["value"] for out in previous}
    )
    return both.filter(F.col(_SEED) == 1).select(*df.columns, *[c for c in previous if c not in df.columns])


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    block: Sequence[Column],
) -> DataFrame:
    """Nulls take the last non-null value before them within the key."""
    return carry(df, keys, order, block, fill=columns)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    block: Sequence[Column],
) -> DataFrame:
    """The value of the row just before, within the key; ``columns`` maps result to source."""
    return carry(df, keys, order, block, previous=columns)


def change_counter(
    df: DataFrame,
    sequence: Sequence[str],
    parent: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    block: Sequence[Column],
    counts: Column | None = None,
) -> DataFrame:
    """Running number of changes of ``value`` under each parent.

    A row counts when its value differs from that of the row before it in the
    whole sequence (the first row has none before it and does not count) and
    ``counts`` holds.  The numbers run per sequence and parent.
    """
    stepped = previous_value(df, sequence, order, {"__before": value}, block)
    return count_changes(stepped, sequence, parent, order, value, "__before", out, block, counts).drop("__before")


def count_changes(
    df: DataFrame,
    sequence: Sequence[str],
    parent: Sequence[str],
    order: Sequence[str],
    value: str,
    before: str,
    out: str,
    block: Sequence[Column],
    counts: Column | None = None,
) -> DataFrame:
    """The counter of :func:`change_counter` where the value of the row before is a column already."""
    changed = F.col(value) != F.col(before)
    if counts is not None:
        changed = counts & changed
    changed = F.coalesce(changed, F.lit(False)).cast("int")
    keys = [*sequence, *[p for p in parent if p not in sequence]]
    return running_sum(df, keys, order, {out: changed}, block)
