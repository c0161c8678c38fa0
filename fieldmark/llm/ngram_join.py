"""N-gram Jaccard join: which documents share most of their word shingles.

The incidence matrix of documents by shingles is multiplied with its transpose in
blocks.  Which entries are formed follows from sizes: two sets of x and y shingles
reach the threshold t only if t * max(x, y) <= min(x, y), and only if they share one
of the x - ceil(t x) + 1 shingles of each that come first in one common order.  So
only those columns are multiplied (rare ones first; the order comes from a histogram
of all shingles with a fixed number of buckets).  A block is the posting list of one
column; a longer list is cut and its pieces meet pairwise.  In a block the overlap of
every pair is bounded from above, by the column's places in both sets and by parity bits
of both, and pairs whose bound is too low are dropped there, so a large group of near
copies makes no table of its pairs.  Overlaps of the pairs left are accumulated over
columns, in the block and then over blocks: what two sets share is what was counted up
to their last common column and at most all that follows it in the shorter rest.  Pairs
under the bound of their sizes go.  Those still open meet a second bound, by parity bits in number with their shingles,
and then whole sets, which are made only for documents of such pairs.

Components come without forming every link.  First each document offers its closest
partner of a block; the offers are counted exactly, shingle by shingle, and merged, and
again those of different components.  Then all remaining pairs between different
components are counted.  A link left uncounted lies within a component, so none is
lost; how often offers are made only decides how many pairs are left for the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.session import settle

from .bits import Chosen, bit, wanted_bits
from .components import components
from .words import groups, mix, parts, windows, words_of

_U = np.uint64
#: log2 of the buckets of the histogram that orders shingles.
BUCKET_BITS = 17
#: Parity bits of a set that travel with its shingles, in words of 64; bits per shingle of the second bound.
PARITY_WORDS, WIDE = 8, 2
#: Rows of a posting list that one block holds; longer lists are cut.
BLOCK = 2048
#: Pairs bounded at once.
PAIRS = 1 << 18
#: Further passes in which documents offer their closest partner in another component.
MERGES = 1


def _shingle_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each text; A-Z counts as a-z."""
    done = 0
    for part in parts(batch, "text"):
        found = words_of(part.column("text"))
        hashes = found.hashes(lower=True)
        runs, bounds = windows(hashes, found.first, words)
        for i in range(part.num_rows):
            a, b = int(found.first[i]), int(found.first[i + 1])
            if b - a >= words:
                yield done + i, np.unique(runs[bounds[i] : bounds[i + 1]])
            elif b > a:  # the whole sequence is the only shingle; its length tells it from others
                whole = windows(hashes[a:b], np.array([0, b - a]), b - a)[0]
                yield done + i, mix(whole ^ _U(b - a))
            else:
                yield done + i, np.zeros(0, _U)
        done += part.num_rows


def _histogram(words: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for part in parts(batch, "text"):
                found = words_of(part.column("text"))
                runs, _ = windows(found.hashes(lower=True), found.first, words)
                total += np.bincount((runs >> _U(64 - BUCKET_BITS)).astype(np.int64), minlength=1 << BUCKET_BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return count


def _levels(docs: DataFrame, words: int) -> np.ndarray:
    """A level of frequency for each bucket, from all shingles of all texts."""
    counts = docs.select("text").mapInArrow(_histogram(words), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = counts.toArrow()  # at most 2 ** BUCKET_BITS rows
    level = np.zeros(1 << BUCKET_BITS, np.uint8)
    level[got["bucket"].to_numpy()] = np.minimum(8 * np.log2(got["n"].to_numpy() + 1), 255).astype(np.uint8)
    return level


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _describe(words: int, percent: int, level: np.ndarray) -> Callable:
    """Size, fingerprint, parity bits and first shingles of each document's set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, parity, first, lengths = [], [], [], [], [], []
            for _, grams in _shingle_sets(batch, words):
                size = len(grams)
                n.append(size)
                one.append(int(mix(grams).sum(dtype=_U).astype(np.int64)))
                two.append(int(mix(grams ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U).astype(np.int64)))
                bits = np.bincount((grams & _U(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
                parity.append(np.packbits(bits.astype(np.uint8)).tobytes())
                keep = size - -(-percent * size // 100) + 1 if size else 0
                order = np.argsort(level[(grams >> _U(64 - BUCKET_BITS)).astype(np.int64)], kind="stable")
                first.append(grams[order[:keep]])
                lengths.append(keep)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            values = np.concatenate([*first, np.zeros(0, _U)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                    _binary(parity), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                ["id", "n", "f1", "f2", "parity", "first"],
            )

    return describe


def _folded(parity: bytes, size: int) -> np.ndarray:
    """Parity bits of a set over fewer places; both sizes are powers of two."""
    return np.bitwise_xor.reduce(np.frombuffer(parity, np.uint8).reshape(-1, size), axis=0)


def _apart(parity: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least possible difference of the sets of rows x and y, by the bits both have."""
    sizes = np.fromiter(map(len, parity), np.int64, len(parity))
    common, out = np.minimum(sizes[x], sizes[y]), np.empty(len(x), np.int64)
    for size in np.unique(common).tolist():
        at = np.flatnonzero(common == size)
        rows, back = np.unique(np.concatenate([x[at], y[at]]), return_inverse=True)
        bits = np.stack([_folded(parity[r], size) for r in rows.tolist()]).view(_U)
        one, two = back[: len(at)], back[len(at) :]
        step = max(1, (1 << 24) // size)
        for k in range(0, len(at), step):
            out[at[k : k + step]] = np.bitwise_count(bits[one[k : k + step]] ^ bits[two[k : k + step]]).sum(axis=1, dtype=np.int64)
    return out


def _close_pairs(batch: pa.RecordBatch, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, row, least possible difference) of pairs of a block that sizes and parity bits allow."""
    col = {c: batch.column(c).to_numpy() for c in ("token", "i", "j", "k", "n", "at", "component")}
    parity = batch.column("parity").to_pylist()
    n = len(col["token"])
    new = np.ones(n, bool)
    new[1:] = (col["token"][1:] != col["token"][:-1]) | (col["i"][1:] != col["i"][:-1]) | (col["j"][1:] != col["j"][:-1])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], n)[np.cumsum(new) - 1]
    partners = stop - np.arange(n) - 1
    done = np.concatenate([[0], np.cumsum(partners)])
    row = 0
    while row < n:
        upto = max(row + 1, int(np.searchsorted(done, done[row] + PAIRS, "right")) - 1)
        x = np.repeat(np.arange(row, upto), partners[row:upto])
        y = x + 1 + np.arange(len(x)) - np.repeat(done[row:upto] - done[row], partners[row:upto])
        nx, ny = col["n"][x], col["n"][y]
        ok = (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & (col["component"][x] != col["component"][y])
        ok &= (col["i"][x] == col["j"][x]) | (col["k"][x] != col["k"][y])
        # before the column at most the smaller place, after it at most the shorter rest
        most = np.minimum(col["at"][x], col["at"][y]) + np.minimum(nx - col["at"][x], ny - col["at"][y])
        ok &= (100 + percent) * most >= percent * (nx + ny)
        x, y = x[ok], y[ok]
        apart = _apart(parity, x, y)
        ok = (100 + percent) * apart <= (100 - percent) * (col["n"][x] + col["n"][y])
        yield x[ok], y[ok], apart[ok]
        row = upto


def _closest(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Each document's closest partner in each block."""
    for batch in groups(batches, ["token", "i", "j"]):
        ids = batch.column("id").to_numpy()
        a, b, d = (np.zeros(0, np.int64) for _ in range(3))
        for x, y, apart in _close_pairs(batch, percent):
            one, two = ids[x], ids[y]
            a, b, d = np.concatenate([a, one, two]), np.concatenate([b, two, one]), np.concatenate([d, apart, apart])
            order = np.lexsort((b, d, a))
            a, b, d = a[order], b[order], d[order]
            first = np.ones(len(a), bool)
            first[1:] = a[1:] != a[:-1]
            a, b, d = a[first], b[first], d[first]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d)], ["a", "b", "d"])


def _overlaps(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that may reach the threshold, with the columns of a block that both have.

    ``sets`` tells pairs of unequal sets under one pair of ids apart; ``shared`` counts
    columns, ``at`` is the place of the last one in a's set, ``room`` the shorter rest
    after it, ``need`` the overlap of the threshold.
    """
    for batch in groups(batches, ["token", "i", "j"]):
        col = {c: batch.column(c).to_numpy().astype(np.int64) for c in ("id", "n", "at", "name")}
        for x, y, _ in _close_pairs(batch, percent):
            turned = col["id"][x] > col["id"][y]
            x, y = np.where(turned, y, x), np.where(turned, x, y)
            a, b, sets, at = col["id"][x], col["id"][y], (col["name"][x] << 32) + col["name"][y], col["at"][x]
            order = np.lexsort((at, sets, b, a))
            a, b, sets, at, x, y = a[order], b[order], sets[order], at[order], x[order], y[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (sets[1:] != sets[:-1])
            start = np.flatnonzero(new)
            shared = np.diff(np.append(start, len(a)))
            last = start + shared - 1
            n, m = col["n"][x[last]], col["n"][y[last]]
            room = np.minimum(n - at[last], m - col["at"][y[last]]) - 1
            need = -(-percent * (n + m) // (100 + percent))
            columns = [a[last], b[last], sets[last], shared, at[last], room, need]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "sets", "shared", "at", "room", "need"])


def _wide_parity(grams: np.ndarray) -> bytes:
    """Parity bits, a power of two in number."""
    width = 64 * PARITY_WORDS << max(0, (WIDE * len(grams) // (64 * PARITY_WORDS)).bit_length())
    bits = np.bincount((grams & _U(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _picked_rows(words: int, wanted: bytes, wide: bool) -> Callable:
    """Parity bits, or the whole sets, of the documents whose bit is set."""
    chosen = Chosen(wanted)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = batch.filter(pa.array(chosen(batch.column("bit"))))
            if picked.num_rows:
                sets = [grams for _, grams in _shingle_sets(picked, words)]
                shown = [_wide_parity(g) if wide else g.tobytes() for g in sets]
                # at least a bit for two shingles, for blocks: of unrelated sets half the bits differ, and the threshold
                # allows (100 - percent) / (100 + percent) of both sizes, which from 80 % on is less
                short = [_folded(b, max(8 * PARITY_WORDS, len(b) // 4)).tobytes() if wide else None for b in shown]
                yield pa.RecordBatch.from_arrays(
                    [picked.column("id"), pa.array(map(len, sets), pa.int64()), _binary(shown), _binary(short)], ["id", "n", "grams", "parity"]
                )

    return rows


def _plausible(percent: int) -> Callable:
    """Pairs whose parity bits allow the threshold; the wider bits are folded onto the others."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            apart = np.empty(batch.num_rows, np.int64)
            for i, (one, two) in enumerate(zip(batch.column("one"), batch.column("two"), strict=True)):
                x, y = one.as_buffer(), two.as_buffer()
                size = min(len(x), len(y))
                apart[i] = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum(dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array((100 + percent) * apart <= (100 - percent) * both))

    return rows


def _linked(percent: int) -> Callable:
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column("one"), batch.column("two"), strict=True):
                x, y = np.frombuffer(one.as_buffer(), _U), np.frombuffer(two.as_buffer(), _U)
                both = np.sort(np.concatenate([x, y]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return linked


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    Documents link when 100 * common shingles >= ``percent`` * shingles of either, over
    distinct runs of ``words`` words; a component is named by its smallest id.

    Defined cases.  A text of fewer words is one shingle; without words, or null, it
    has none and links with nothing.  Rows that repeat an id count as one document: they
    share a component.  A row with a null id has a null component and links nothing.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    level = _levels(docs, words)
    sets = settle(docs.mapInArrow(_describe(words, percent, level), "id bigint, n bigint, f1 bigint, f2 bigint, parity binary, first array<bigint>"))
    # equal sets are one class, which its smallest id stands for
    classes = settle(sets.where("n > 0 and id is not null").groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")))
    reps = sets.join(classes.select(F.col("rep").alias("id"), "n", "f1", "f2"), ["id", "n", "f1", "f2"], "left_semi")
    postings = reps.select("id", "n", F.shiftright("f1", 32).cast("int").alias("name"), F.posexplode("first").alias("at", "token"))
    lists = postings.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    shared = settle(postings.join(lists, "token"))
    parity = settle(reps.select("id", "n", "f1", "f2", "parity").join(shared.select("id").distinct(), "id", "left_semi"))

    def block_pairs(rows: DataFrame, parity: DataFrame, made: Callable, schema: str) -> DataFrame:
        """``rows``: id, n, name, at, token, m, component."""
        pieces = F.ceil(F.col("m") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("id"), pieces).cast("int")
        cells = (
            rows.join(parity.select("id", "n", "parity"), ["id", "n"])
            .withColumns({"k": own, "other": F.explode(F.sequence(F.lit(0), pieces - 1))})
            .select("token", F.least("k", "other").alias("i"), F.greatest("k", "other").alias("j"), "k", "id", "n", "name", "at", "parity", "component")
        )
        keys = ["token", "i", "j"]
        return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: made(batches, percent), schema)

    def picked(ids: DataFrame, wide: bool) -> DataFrame:
        placed = docs.where("id is not null").withColumn("bit", bit("id"))
        return settle(placed.mapInArrow(_picked_rows(words, wanted_bits(ids), wide), "id bigint, n bigint, grams binary, parity binary").join(ids, "id", "left_semi"))

    def paired(pairs: DataFrame, kept: DataFrame) -> DataFrame:
        one = kept.select(F.col("id").alias("a"), "n", F.col("grams").alias("one"))
        two = kept.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("grams").alias("two"))
        return pairs.join(one, "a").join(two, "b")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = settle(paired(pairs, sketches).mapInArrow(_plausible(percent), "a bigint, b bigint"))
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        return paired(pairs, picked(ends, wide=False)).select("a", "b", "one", "two").mapInArrow(_linked(percent), "a bigint, b bigint")

    def closest(rows: DataFrame, by: DataFrame) -> DataFrame:
        """The closest partner of each document outside its component."""
        offers = block_pairs(rows, by, _closest, "a bigint, b bigint, d bigint")
        return settle(offers.groupBy("a").agg(F.min(F.struct("d", "b")).alias("near")).select("a", F.col("near.b").alias("b")))

    def accumulated(rows: DataFrame, by: DataFrame) -> DataFrame:
        """Pairs whose overlap over all columns, with what may follow the last of them, reaches the threshold."""
        columns = block_pairs(rows, by, _overlaps, "a bigint, b bigint, sets bigint, shared bigint, at bigint, room bigint, need bigint")
        total = columns.groupBy("a", "b", "sets").agg(
            F.sum("shared").alias("shared"), F.max(F.struct("at", "room"))["room"].alias("room"), F.min("need").alias("need")
        )
        return total.where("shared + room >= need").select("a", "b").distinct()

    def unordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def across(merged: DataFrame) -> DataFrame:
        """Postings of documents with a partner, in lists that hold more than one component."""
        named = near.join(merged, "id", "left").withColumn("component", F.coalesce("component", "id"))
        open_lists = named.groupBy("token").agg((F.min("component") != F.max("component")).alias("open")).where("open").select("token")
        return named.join(open_lists, "token", "left_semi")

    first = closest(shared.withColumn("component", F.col("id")), parity)
    # every document with a partner stands in column a; only these can have others
    sketches = picked(first.select(F.col("a").alias("id")), wide=True)
    near = settle(shared.join(sketches.select("id").distinct(), "id", "left_semi"))
    tested = settle(unordered(first))
    found = settle(verified(tested))
    for _ in range(MERGES):
        # longer sets bring more bits from here on, so that an offer is nearly always a link
        pairs = settle(unordered(closest(across(components(found)), sketches)).join(tested, ["a", "b"], "left_anti"))
        tested, found = settle(tested.union(pairs)), settle(found.union(verified(pairs)))
    rest = settle(accumulated(across(components(found)), sketches))
    extra = verified(rest.join(tested, ["a", "b"], "left_anti"))

    members = sets.where("n > 0 and id is not null").join(classes, ["n", "f1", "f2"]).select("id", "rep").distinct()
    # an id that repeats with unequal texts joins its classes
    repeated = members.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").select("id")
    ties = members.join(repeated, "id", "left_semi").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    total = components(found.union(extra).union(ties))
    placed = (
        members.join(total.select(F.col("id").alias("rep"), "component"), "rep", "left")
        .groupBy("id")
        .agg(F.min(F.least(F.coalesce("component", "rep"), "id")).alias("component"))
    )
    return (
        sets.select("id", F.col("n").alias("n_shingles"))
        .join(placed, "id", "left")
        .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    )
