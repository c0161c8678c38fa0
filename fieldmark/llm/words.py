"""Words of many texts at once, as numpy arrays.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed
and carriage return.  Texts come as Arrow string arrays; nothing here loops over
words or characters in Python.  Hashes are 64 bits wide: a sum of random values per
byte times powers of an odd number, so that any stretch of a text is a difference
of two running sums, mixed once more at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes whose running sums are held at once.
SLICE = 1 << 18
#: Bytes of text that one array of words is made from; one longer text stands alone.
PART = 1 << 20

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 63, 256, dtype=np.uint64)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, made longer on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), np.ones(1, _U), np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up, self.down


_IN_WORD, _IN_WINDOW = _Powers(_BASE), _Powers(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over all of them."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@dataclass
class Words:
    """Words of consecutive texts: byte spans into ``data``; text i has words first[i] to first[i + 1], bytes from bounds[i]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One hash per word; ``lower`` takes A-Z as a-z."""
        values, out, n = _byte_values(lower), np.empty(len(self.start), _U), len(self.start)
        begin = 0
        while begin < n:
            stop = max(begin + 1, int(np.searchsorted(self.end, self.start[begin] + SLICE, "right")))
            low, high = int(self.start[begin]), int(self.end[stop - 1])
            up, down = _IN_WORD.upto(min(high - low, SLICE) + 1)
            if high - low <= SLICE:
                sums = np.zeros(high - low + 1, _U)
                np.cumsum(values[self.data[low:high]] * up[: high - low], out=sums[1:])
                at = self.start[begin:stop] - low
                out[begin:stop] = (sums[self.end[begin:stop] - low] - sums[at]) * down[at]
            else:  # one word longer than a slice
                total, step = 0, pow(_BASE, SLICE, 1 << 64)
                shift = 1
                for k in range(low, high, SLICE):
                    piece = values[self.data[k : min(k + SLICE, high)]]
                    total = (total + shift * int((piece * up[: len(piece)]).sum(dtype=_U))) % (1 << 64)
                    shift = shift * step % (1 << 64)
                out[begin] = total
            begin = stop
        return mix(out)

    def text(self, i: int, keep: np.ndarray | None = None) -> bytes:
        """Words of text i, joined by one blank; ``keep`` marks those wanted."""
        a, b = int(self.first[i]), int(self.first[i + 1])
        picked = range(a, b) if keep is None else (np.flatnonzero(keep) + a).tolist()
        raw, start, end = self.data, self.start, self.end
        return b" ".join(raw[start[k] : end[k]].tobytes() for k in picked)


def words_of(texts: pa.Array) -> Words:
    """Words of an Arrow string array; a null text has none."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return Words(raw, none, none, np.zeros(n + 1, np.int64), bounds)
    inside = ~_SPACE[raw]
    before = np.empty(len(raw), bool)
    before[0], before[1:] = False, inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(raw)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(raw), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(raw, start, end, np.searchsorted(start, bounds), bounds)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and the texts' bounds among them; runs never cross texts."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    n = len(hashes)
    if n < size:
        return np.zeros(0, _U), bounds
    up, down = _IN_WINDOW.upto(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(hashes * up[:n], out=sums[1:])
    every = (sums[size:] - sums[:-size]) * down[: n - size + 1]
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], counts)
    return mix(every[at]), bounds


def parts(batch: pa.RecordBatch, column: str, most: int = PART) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in pieces of at most ``most`` bytes of ``column``, one row at least."""
    texts = batch.column(column)
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    total, begin = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


def _in_one(table: pa.Table) -> pa.RecordBatch:
    """All rows in one batch.  Columns of over 2 GB of bytes, which would be cut, get wide offsets."""
    made = table.combine_chunks().to_batches()
    if len(made) > 1:
        wide = {pa.binary(): pa.large_binary(), pa.string(): pa.large_string()}
        made = table.cast(pa.schema([f.with_type(wide.get(f.type, f.type)) for f in table.schema])).combine_chunks().to_batches()
    if len(made) != 1:
        raise RuntimeError(f"{table.num_rows} rows of one group do not fit one batch")
    return made[0]


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, recut so that no group of equal keys spans two of them."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        last = [batch.column(k)[-1] for k in keys]
        cut = batch.num_rows
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == v.as_py()
        if not same.all():
            cut = int(np.flatnonzero(~same)[-1]) + 1
            whole = table.slice(0, cut) if held is None else pa.concat_tables([held, table.slice(0, cut)])
            held = table.slice(cut)
            yield _in_one(whole)
        else:
            held = table if held is None else pa.concat_tables([held, table])
    if held is not None:
        yield _in_one(held)
