"""Substring dedup: words covered by a run that already stands in an earlier document.

Fixed-block anchors.  With runs of 2 b words, any run holds a whole block of b words
that starts at a multiple of b in the document it repeats.  So the index holds each
document's non-overlapping blocks, and every rolling window of b words probes it.

Probes are as many as words, so they travel packed: per piece of input and shard of
the hash space one row with 32-bit keys, sorted by document.  A shard tells which keys
are blocks and occur more than once.  Where a window hits, the hit is extended: all
runs around it are compared by 64-bit hashes of their words, a run is removed where a
smaller id holds it too, and touching runs make up the maximal repeat.

What a pass leaves is per document, in tables; texts are shuffled only for documents
with hits.  Entries of a key are one per document, so a passage shared by many costs
each shard as much as its documents do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.session import settle

from .bits import Chosen, bit, wanted_bits
from .words import Words, groups, parts, windows, words_of

_U = np.uint64
#: Shards of the hash space for each shuffle partition.
SHARDS_EACH = 2


def shard_bits(docs: DataFrame) -> int:
    """log2 of the number of shards, which follows the session's shuffle partitions."""
    return max(6, (SHARDS_EACH * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays by planes of bytes, compressed: high bytes of small numbers take no room."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(packed, n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def _owners(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(bounds))


_PROBES = "shard int, piece bigint, n int, ids boolean, packed binary"


#: Bytes of text whose probes travel together.
PIECE = 1 << 22


def _probe_rows(block: int, bits: int) -> Callable:
    """Packed probes of each piece of input by shard, and one row that names its documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text", PIECE):
                found = words_of(part.column("text"))
                hashes, bounds = windows(found.hashes(), found.first, block)
                if not len(hashes):
                    continue
                owner = _owners(bounds)
                anchor = (np.arange(len(hashes)) - bounds[owner]) % block == 0
                shard = (hashes >> _U(64 - bits)).astype(np.int64)
                key = ((hashes >> _U(32 - bits)) & _U(0xFFFFFFFF)).astype(np.uint32)
                # once per document and key, an anchor first
                order = np.lexsort((~anchor, key, owner, shard))
                shard, owner, key, anchor = shard[order], owner[order], key[order], anchor[order]
                first = np.ones(len(key), bool)
                first[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (shard[1:] != shard[:-1])
                shard, owner, key, anchor = shard[first], owner[first], key[first], anchor[first]
                ids = part.column("id").to_numpy()
                piece = int.from_bytes(hashlib.blake2b(ids.tobytes() + found.first.tobytes(), digest_size=8).digest(), "little", signed=True)
                at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                ends = np.append(at[1:], len(shard))
                step = np.diff(owner, prepend=0)
                step[at] = owner[at]
                marked = (step * 2 + anchor).astype(np.uint32)
                packed = [_packed(key[a:b], marked[a:b]) for a, b in zip(at, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(shard[at], piece % (1 << bits)).astype(np.int32)),
                        pa.array(np.full(len(at) + 1, piece, np.int64)),
                        pa.array(np.append(ends - at, len(ids)).astype(np.int32)),
                        pa.array([False] * len(at) + [True]),
                        pa.array([*packed, _packed(ids)], pa.binary()),
                    ],
                    ["shard", "piece", "n", "ids", "packed"],
                )

    return rows


def _hit_rows(bits: int) -> Callable:
    """Of each shard, the keys of every document that other windows share and that are an anchor somewhere."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, ["shard"]):
            named = batch.filter(batch.column("ids"))
            if named.num_rows:
                at = named.schema.get_field_index("packed")  # of a large group it may have wide offsets
                yield named.set_column(at, "packed", named.column(at).cast(pa.binary()))
            for group in _by(batch.filter(pc.invert(batch.column("ids"))), "shard"):
                shard, pieces, counts = group.column("shard")[0].as_py(), group.column("piece").to_numpy(), group.column("n").to_numpy()
                keys, owners, anchors = [], [], []
                for n, packed in zip(counts.tolist(), group.column("packed"), strict=True):
                    key, marked = _unpacked(packed.as_buffer(), n, np.uint32, np.uint32)
                    keys.append(key)
                    owners.append(np.cumsum(marked >> 1, dtype=np.int64))
                    anchors.append(marked & 1)
                key, owner, row = np.concatenate(keys), np.concatenate(owners), np.repeat(np.arange(len(counts)), counts)
                order = np.argsort(key, kind="stable")
                new = np.append(True, key[order][1:] != key[order][:-1])
                begin = np.flatnonzero(new)
                size = np.diff(np.append(begin, len(key)))
                wanted = (size > 1) & (np.add.reduceat(np.concatenate(anchors)[order].astype(np.int64), begin) > 0)
                hit = np.sort(order[np.repeat(wanted, size)])
                at = np.flatnonzero(np.append(True, row[hit][1:] != row[hit][:-1])) if len(hit) else hit
                ends = np.append(at[1:], len(hit)).astype(np.int64)[: len(at)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), shard, np.int32)),
                        pa.array(pieces[row[hit[at]]]),
                        pa.array((ends - at).astype(np.int32)),
                        pa.array([False] * len(at), pa.bool_()),
                        pa.array([_packed(key[hit[a:b]], owner[hit[a:b]].astype(np.uint32)) for a, b in zip(at, ends, strict=True)], pa.binary()),
                    ],
                    ["shard", "piece", "n", "ids", "packed"],
                )

    return rows


def _by(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of equal values of a column."""
    if not batch.num_rows:
        return
    values = batch.column(column).to_numpy()
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def _document_rows(bits: int) -> Callable:
    """Hits of each piece of input, by the documents it held."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, ["piece"]):
            for group in _by(batch, "piece"):
                ids, owners, hits = None, [], []
                for shard, n, named, packed in zip(*(group.column(c) for c in ("shard", "n", "ids", "packed")), strict=True):
                    if named.as_py():
                        (ids,) = _unpacked(packed.as_buffer(), n.as_py(), np.int64)
                    else:
                        key, owner = _unpacked(packed.as_buffer(), n.as_py(), np.uint32, np.uint32)
                        owners.append(owner.astype(np.int64))
                        hits.append((np.int64(shard.as_py()) << 32) | key.astype(np.int64))
                if not owners:
                    continue
                owner, hit = np.concatenate(owners), np.concatenate(hits)
                order = np.argsort(owner, kind="stable")
                owner, hit = owner[order], hit[order]
                at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                offsets = pa.array(np.append(at, len(owner)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(ids[owner[at]]), pa.ListArray.from_arrays(offsets, pa.array(hit))], ["id", "hits"])

    return rows


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """Values of each list; none for null."""
    for value in column:
        yield value.values.to_numpy(zero_copy_only=False) if value.is_valid else np.zeros(0, np.int64)


def _run_rows(block: int, bits: int) -> Callable:
    """All runs around the hits of each document, packed by shard with the document's id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                found = words_of(part.column("text"))
                words = found.hashes()
                short, short_bounds = windows(words, found.first, block)
                runs, bounds = windows(words, found.first, 2 * block)
                spot = (short >> _U(32 - bits)).astype(np.int64)
                ids = part.column("id").to_numpy()
                keys, owners = [], []
                for i, hits in enumerate(_lists(part.column("hits"))):
                    n = bounds[i + 1] - bounds[i]
                    if n > 0:
                        hit = np.isin(spot[short_bounds[i] : short_bounds[i + 1]], hits).astype(np.int64)
                        total = np.concatenate([[0], np.cumsum(hit)])
                        # run p holds the windows p to p + block
                        around = total[block + 1 : block + 1 + n] > total[:n]
                        picked = np.unique(runs[bounds[i] : bounds[i + 1]][around])
                        keys.append(picked)
                        owners.append(np.full(len(picked), ids[i]))
                if not keys or not sum(map(len, keys)):
                    continue
                key, owner = np.concatenate(keys), np.concatenate(owners)
                shard = (key >> _U(64 - bits)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                shard, key, owner = shard[order], key[order], owner[order]
                at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                ends = np.append(at[1:], len(shard))
                step = np.diff(owner, prepend=0)
                step[at] = owner[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[at].astype(np.int32)),
                        pa.array((ends - at).astype(np.int32)),
                        pa.array([_packed(key[a:b], step[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary()),
                    ],
                    ["shard", "n", "packed"],
                )

    return rows


def _repeat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each shard, the runs of every document that a smaller id holds too."""
    for batch in groups(batches, ["shard"]):
        for group in _by(batch, "shard"):
            keys, owners = [], []
            for n, packed in zip(group.column("n").to_pylist(), group.column("packed"), strict=True):
                key, step = _unpacked(packed.as_buffer(), n, np.uint64, np.int64)
                keys.append(key)
                owners.append(np.cumsum(step))
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((owner, key))
            key, owner = key[order], owner[order]
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            least = np.repeat(owner[begin], np.diff(np.append(begin, len(key))))
            later = owner > least
            key, owner = key[later], owner[later]
            order = np.argsort(owner, kind="stable")
            key, owner = key[order], owner[order]
            at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(key) else np.zeros(0, np.int64)
            offsets = pa.array(np.append(at, len(key)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[at]), pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int64)))], ["id", "runs"]
            )


def _kept_words(found: Words, keep: np.ndarray) -> Iterator[bytes]:
    """Kept words of each text, joined by one blank."""
    start, end = found.start[keep], found.end[keep]
    count = np.concatenate([[0], np.cumsum(keep)])[found.first]
    follows = np.ones(len(start), np.int64)  # a blank after each word but a text's last
    follows[count[1:][count[1:] > count[:-1]] - 1] = 0
    data = np.append(found.data, np.uint8(0x20))
    data[end[follows == 1]] = 0x20
    edge = np.zeros(len(data) + 1, np.int8)
    np.add.at(edge, start, 1)
    np.add.at(edge, end + follows, -1)
    kept = data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)].tobytes()
    length = np.concatenate([[0], np.cumsum(end - start + follows)])
    bounds = length[count].tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        yield kept[a:b]


def _kept_rows(run: int, with_text: bool) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                found = words_of(part.column("text"))
                hashes, bounds = None, None
                gone = np.zeros(len(found.start) + 1, np.int64)
                for i, runs in enumerate(_lists(part.column("runs"))):
                    if len(runs):
                        if hashes is None:
                            hashes, bounds = windows(found.hashes(), found.first, run)
                        at = np.flatnonzero(np.isin(hashes[bounds[i] : bounds[i + 1]].view(np.int64), runs)) + found.first[i]
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + run, -1)
                keep = np.cumsum(gone[:-1]) == 0
                kept = list(_kept_words(found, keep))
                removed = np.add.reduceat(np.append(~keep, False).astype(np.int64), np.minimum(found.first[:-1], len(keep)))
                removed[found.counts == 0] = 0
                columns = [part.column("row"), pa.array(found.counts), pa.array(removed), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                names = ["row", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    whole = part.column("text").to_pylist()
                    columns.append(pa.array([k.decode() if r else t for k, r, t in zip(kept, removed.tolist(), whole, strict=True)], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows


def _chosen_rows(marks: bytes) -> Callable:
    """Rows whose bit is set, unchanged."""
    chosen = Chosen(marks)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(chosen(batch.column("bit")))).drop_columns(["bit"])

    return rows


def _untouched_rows(marks: bytes, run: int, with_text: bool) -> Callable:
    """Results of rows whose bit is not set: they lose nothing."""
    chosen, kept = Chosen(marks), _kept_rows(run, with_text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array(~chosen(batch.column("bit"))))
            yield from kept(iter([rest.append_column("runs", pa.nulls(rest.num_rows, pa.list_(pa.int64())))]))

    return rows


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 50, with_text: bool = False) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with n_words, n_removed and kept_sha256 (kept words joined by one blank).

    A word goes if a run of ``words`` consecutive words covers it (an even number) whose
    words also start in a document with a smaller id; runs are judged on the input.
    ``with_text`` adds kept_text: the text itself where nothing went.

    Defined cases.  A null text has no words.  Rows that repeat an id do not remove each
    other's words, as neither id is smaller; each loses what smaller ids hold.  A row with
    a null id keeps all its words and takes none from others.  ``docs`` is read several
    times: give a stored table.
    """
    block, bits = words // 2, shard_bits(docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    texts = rows.where("id is not null").select("id", "text")
    probes = texts.mapInArrow(_probe_rows(block, bits), _PROBES)
    shared = probes.repartition("shard").sortWithinPartitions("shard").mapInArrow(_hit_rows(bits), _PROBES)
    named = shared.repartition("piece").sortWithinPartitions("piece").mapInArrow(_document_rows(bits), "id bigint, hits array<bigint>")
    hits = settle(named)

    marks = wanted_bits(hits.select("id"))
    placed = rows.withColumn("bit", bit("id")).withColumn("bit", F.when(F.col("id").isNotNull(), F.col("bit")))
    plain = "row struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in docs.schema.fields) + ">"
    out = f"{plain}, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if with_text else "")
    touched = placed.mapInArrow(_chosen_rows(marks), f"{plain}, id bigint, text string")

    per_id = hits.groupBy("id").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    runs = touched.select("id", "text").join(per_id, "id").mapInArrow(_run_rows(block, bits), "shard int, n int, packed binary")
    repeats = runs.repartition("shard").sortWithinPartitions("shard").mapInArrow(_repeat_rows, "id bigint, runs array<bigint>")
    later = repeats.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs"))
    judged = touched.join(later, "id", "left").select("row", "text", "runs").mapInArrow(_kept_rows(words, with_text), out)
    return judged.union(placed.select("row", "text", "bit").mapInArrow(_untouched_rows(marks, words, with_text), out))
