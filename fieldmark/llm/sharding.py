"""Sharding: vector bin packing of documents by bytes, tokens and rows together.

Documents of equal text are a group.  Groups that hold much of a shard are cut into
parts by a hash of their ids and places in the table; there are few of them, bounded by the number of shards,
and they are placed first.  All others are dealt by hash into buckets, each with its
share of what the shards can still take, and every bucket is packed by itself: largest
first, into the shard where the dot product of group and residual capacity is highest.
Shares are exact, so shards come out as even as the smallest groups of a bucket allow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldmark.session import settle

from .words import groups

#: A group is placed first if it holds more than one part in FINE of a shard's capacity, in any
#: dimension, and cut into parts of that size if it holds more than one in CUT.
FINE, CUT = 64, 4
#: Groups that one bucket packs, about.
BUCKET = 20_000
_SIZES = ("bytes", "tokens", "rows")
#: What an even share of each counts: bytes first, as they make the law.
WEIGHTS = np.array([32.0, 4.0, 1.0])


def place(sizes: np.ndarray, residual: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The shard of each group, in the order given.  ``residual`` (shards x dimensions) is used up.

    Sizes count as weighted shares of ``totals``.  Where nothing is left anywhere, the shard that
    is least overfull has the highest product, so ties and overflow need no rule.
    """
    scale = WEIGHTS / np.maximum(totals, 1)
    left, items = residual * scale, sizes * scale
    out = np.empty(len(items), np.int64)
    for i, item in enumerate(items):
        best = int(np.argmax(left @ item))
        out[i] = best
        left[best] -= item
    residual[:] = left / scale
    return out


def _bucket_rows(residual: np.ndarray, rest: np.ndarray, totals: np.ndarray) -> Callable:
    """Packs whole buckets: ``residual`` is shared out by each bucket's part of ``rest``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, ["bucket"]):
            buckets = batch.column("bucket").to_numpy()
            at = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
            shards = np.empty(batch.num_rows, np.int64)
            sizes = np.stack([batch.column(c).to_numpy().astype(float) for c in _SIZES], axis=1)
            for a, b in zip(at.tolist(), [*at[1:].tolist(), batch.num_rows], strict=True):
                own = sizes[a:b]
                share = np.divide(own.sum(axis=0), rest, out=np.zeros(len(rest)), where=rest > 0)
                # hash decides among equal sizes; the bucket turns which shard is asked first
                order = np.lexsort((np.arange(b - a), -(own / np.maximum(totals, 1)).sum(axis=1)))
                turn = int(buckets[a]) % len(residual)
                placed = place(own[order], np.roll(residual, -turn, axis=0) * share, totals)
                shards[a + order] = (placed + turn) % len(residual)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), pa.array(shards.astype(np.int32))], ["key", "part", "shard"])

    return rows


def shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, size, tokens, text_crc32, shard and slot of every row.

    A size is the text's UTF-8 bytes plus 1; tokens are its words.  Slots are gapless from
    0 in each shard.

    Defined cases.  A null text counts as empty.  Equal texts go to one shard unless their
    group is too large for even shards.  Rows that repeat, or whose id is null, are rows
    like any other.  With fewer rows than shards some shards stay empty.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    rows = settle(
        docs.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
            (F.octet_length(text) + 1).cast("long").alias("bytes"),
            F.size(F.array_remove(F.split(blank, " "), "")).cast("long").alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("place"),  # stored with the rest; tells rows of one id apart
        )
    )
    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    whole = rows.agg(*sums).first()
    totals = np.array([float(whole[c] or 0) for c in _SIZES])
    limit = totals / (n_shards * FINE)
    grouped = settle(rows.groupBy("key").agg(*sums))
    large = F.lit(False)
    for c, most in zip(_SIZES, limit.tolist(), strict=True):
        large |= F.col(c) > most
    # at most 3 * n_shards * FINE groups can be large, whatever the corpus
    parts = F.ceil(F.greatest(*[F.col(c) / F.lit(max(most, 1e-9)) for c, most in zip(_SIZES, limit.tolist(), strict=True)])).cast("int")
    cut = grouped.where((parts > FINE // CUT) & (F.col("rows") > 1)).select("key", F.least(parts, F.col("rows")).cast("int").alias("parts"))
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("id", "text_crc32", "place"), F.col("parts"))).otherwise(0).cast("int")
    dealt = rows.join(F.broadcast(cut), "key", "left").withColumn("part", part).drop("parts")
    items = settle(dealt.groupBy("key", "part").agg(*sums))

    first = items.where(large).toPandas().sort_values([*_SIZES, "part"], ascending=False, kind="stable")  # bounded, as above
    first["text"] = [bytes(k) for k in first["key"]]
    first = first.sort_values([*_SIZES, "text", "part"], ascending=False, kind="stable")
    residual = np.tile(totals / n_shards, (n_shards, 1))
    sizes = first[list(_SIZES)].to_numpy(float)
    rest = totals - sizes.sum(axis=0)
    chosen = place(sizes, residual, totals)
    placed_first = spark.createDataFrame(
        [(k, int(p), int(s)) for k, p, s in zip(first["text"], first["part"], chosen, strict=True)], "key binary, part int, shard int"
    )
    small = items.where(~large)
    n_buckets = max(1, round(items.count() / BUCKET))
    bucketed = small.withColumn("bucket", F.pmod(F.xxhash64("key", "part"), F.lit(n_buckets)).cast("int"))
    placed = (
        bucketed.repartition("bucket").sortWithinPartitions("bucket", "key", "part")
        .mapInArrow(_bucket_rows(residual, rest, totals), "key binary, part int, shard int")
    )
    everywhere = settle(dealt.join(settle(placed.union(placed_first)), ["key", "part"]).drop("key", "part", "place"))

    # slots: rows of a shard are counted by lane, lanes follow each other
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laned = everywhere.withColumn("lane", F.pmod(F.xxhash64("id", "text_crc32", "bytes"), F.lit(lanes)).cast("int"))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = laned.groupBy("shard", "lane").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    order = Window.partitionBy("shard", "lane").orderBy("id", "text_crc32")
    numbered = laned.withColumn("place", F.row_number().over(order) - 1).join(offsets, ["shard", "lane"])
    return numbered.select(
        F.col("id").alias(id_col), F.col("bytes").alias("size"), "tokens", "text_crc32", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot")
    )
