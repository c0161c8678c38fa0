"""A set of ids as bits of their hashes: of fixed size, so that it can go to every task.

It only spares work: an id that is not in the set may pass, and a join decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of the number of bits.
WANTED_BITS = 23


def bit(column: str) -> Column:
    """Which bit an id has."""
    return F.shiftrightunsigned(F.xxhash64(column), 64 - WANTED_BITS).cast("int")


def wanted_bits(ids: DataFrame, column: str = "id") -> bytes:
    """2 ** WANTED_BITS bits, whatever the number of ids."""
    one_based = bit(column) + 1
    maps = (
        ids.select(F.bitmap_bucket_number(one_based).alias("part"), F.bitmap_bit_position(one_based).alias("place"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )
    out = bytearray((1 << WANTED_BITS) // 8)
    for row in maps.collect():  # at most 2 ** WANTED_BITS / 32768 rows of 4 KB
        out[4096 * (row["part"] - 1) : 4096 * row["part"]] = bytes(row["bits"])
    return bytes(out)


class Chosen:
    """Which rows of a batch have their bit set."""

    def __init__(self, marks: bytes):
        self.marks = np.frombuffer(marks, np.uint8)

    def __call__(self, bits: pa.Array) -> np.ndarray:
        """A null bit is never set."""
        at = np.asarray(bits.fill_null(0))
        return (((self.marks[at >> 3] >> (at & 7)) & 1) == 1) & np.asarray(bits.is_valid())
