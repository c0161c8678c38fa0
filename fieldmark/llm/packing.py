"""Packing: documents into sequences of a fixed length, in their order.

A stretch of input is one stream of ids.  Dynamic programming chooses where windows
end: after a document, after a sentence, or, where neither is near, inside one.  The
cost is padding plus a penalty for what the cut goes through.  For windows that are
padded to the full length L the best start of a window that ends at p minimises
best[i] + p_i over the starts within L, which a monotone queue keeps at its head; a
window whose length is a power of two needs no padding and is looked up.  Nothing is
shuffled: each task packs the documents it reads.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import Remembered, gather
from .words import Words, parts, words_of

#: Penalties of a cut after a sentence and inside one, in tokens of padding.
SENTENCE, INSIDE = 4, 64
#: Penalty of a window shorter than the full length, which is one more sequence for its few ids.
SHORT = 32
#: Within a stretch without sentence ends longer than ``FAR``, every ``EACH`` tokens may be cut.
FAR, EACH = 64, 16
#: Words that the tokenizer gets at once, and in one text; marks that are a piece of their own behind letters.
TOGETHER, JOINED, MARKS = 8_000, 500, frozenset(".,;:!?")
#: Bytes of text that are packed together at most, but for a longer text.
STREAM = 1 << 21

_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[list(b".!?")] = True
_TOKENIZERS: dict[str, tuple] = {}


def _word_ends(tokenizer: Any) -> np.ndarray | None:
    """Which ids end a piece of a word, where the model marks that; else nothing."""
    from tokenizers.pre_tokenizers import ByteLevel

    model = json.loads(tokenizer.to_str())["model"]
    suffix = model.get("end_of_word_suffix")
    if model["type"] != "BPE" or not suffix or any(f"{c}{suffix}" not in model["vocab"] for c in ByteLevel.alphabet()):
        return None
    ends = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
    ends[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
    return ends


def _least_pieces(word: str) -> int:
    """1 for letters alone, 2 for letters before one mark; 0 for what is counted by its offsets."""
    if word.isalpha():
        return 1
    return 2 if word[-1] in MARKS and word[:-1].isalpha() else 0


def _joined_ids(tokenizer: Any, ends: np.ndarray | None, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of ``words`` in a row, and how many each has; many go in one text, as a call costs more than a word.

    Letters make one piece at least and a mark behind them one more, so where a text has as many
    pieces as that in all, each word has its own.  Other words are told apart by their offsets.
    """
    expected = np.array([_least_pieces(w) if ends is not None else 0 for w in words], np.int64)
    known, others = np.flatnonzero(expected), [np.flatnonzero(expected == 0)]
    places, ids, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]

    def texts(some: np.ndarray) -> tuple[list[np.ndarray], list[str]]:
        cut = [some[k : k + JOINED] for k in range(0, len(some), JOINED)]
        return cut, [" ".join([words[i] for i in each.tolist()]) for each in cut]

    cut, joined = texts(known)
    for some, encoded in zip(cut, tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
        made = np.array(encoded.ids, np.int32)
        last = np.flatnonzero(ends[made]) + 1
        if len(last) == expected[some].sum() and last[-1] == len(made):
            places.append(some)
            ids.append(made)
            count.append(np.diff(last[np.cumsum(expected[some]) - 1], prepend=0))
        else:
            others.append(some)
    cut, joined = texts(np.concatenate(others))
    for some, encoded in zip(cut, tokenizer.encode_batch(joined, add_special_tokens=False), strict=True):
        begins = np.array(encoded.offsets, np.int64).reshape(-1, 2)[:, 0]
        stops = np.cumsum([len(words[i]) + 1 for i in some.tolist()])
        places.append(some)
        ids.append(np.array(encoded.ids, np.int32))
        count.append(np.bincount(np.searchsorted(stops, begins, "right"), minlength=len(some)))
    order, sizes = np.argsort(np.concatenate(places)), np.concatenate(count)
    return gather(np.concatenate(ids), (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]


def word_ids(path: str, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words and how many each has, for a tokenizer that drops white space.

    Such a tokenizer's ids of a text are those of its words: no rule of it looks across
    a blank.  Each worker encodes a word once.
    """
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _TOKENIZERS[path] = tokenizer, _word_ends(tokenizer), Remembered()
    tokenizer, ends, remembered = _TOKENIZERS[path]

    def encode(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat, count = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for begin in range(0, len(places), TOGETHER):
            some = places[begin : begin + TOGETHER]
            words = [found.data[a:b].tobytes().decode() for a, b in zip(found.start[some].tolist(), found.end[some].tolist(), strict=True)]
            made, sizes = _joined_ids(tokenizer, ends, words)
            flat.append(made)
            count.append(sizes)
        return np.concatenate(flat), np.concatenate(count)

    return remembered.ids(found.hashes(), encode)


def cut_places(ends: np.ndarray, sentences: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a window may end, ascending, and the penalty of each place."""
    total = int(ends[-1])
    soft = np.union1d(ends, sentences)
    gaps = np.diff(soft, prepend=0)
    far = np.flatnonzero(gaps > FAR)
    each = [np.arange(soft[i] - gaps[i] + EACH, soft[i], EACH) for i in far.tolist()]
    # at the end of the stream any place, so that the rest can be made of powers of two
    inside = np.concatenate([*each, np.arange(max(1, total - length), total)]).astype(np.int64)
    places = np.union1d(soft, inside)
    penalty = np.full(len(places), INSIDE, np.int64)
    penalty[np.searchsorted(places, sentences)] = SENTENCE
    penalty[np.searchsorted(places, ends)] = 0
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, length: int) -> np.ndarray:
    """Ends of the windows of least padding plus penalties."""
    spots = np.concatenate([[0], places])
    exact: list[tuple[np.ndarray, np.ndarray]] = []
    size = 1
    while size <= length:
        begin = np.searchsorted(spots, spots - size)
        hit = np.flatnonzero((spots >= size) & (spots[begin] == spots - size))
        exact.append((hit, begin[hit]))
        size *= 2
    ends = np.concatenate([e for e, _ in exact])
    order = np.argsort(ends, kind="stable")
    starts = np.concatenate([s for _, s in exact])[order].tolist()
    bounds = np.searchsorted(ends[order], np.arange(len(spots) + 1)).tolist()
    at, extra = spots.tolist(), [0, *penalty.tolist()]
    best, origin = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + place, index), values ascending
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[0][1]] < p - length:
            queue.popleft()
        value, i = queue[0]
        value += length - p
        for k in starts[bounds[j] : bounds[j + 1]]:
            price = best[k] + (SHORT if p - at[k] < length else 0)
            if price < value:
                value, i = price, k
        value += extra[j]
        best[j], origin[j] = value, i
        value += p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = origin[j]
    return np.array(cuts[::-1], np.int64)


def _piece_rows(path: str, end_id: int, length: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 36
        for batch in batches:
            for part in parts(batch, "text", STREAM):
                found = words_of(part.column("text"))
                ids, count = word_ids(path, found)
                after = np.concatenate([[0], np.cumsum(count)])  # ids up to each word
                bounds = after[found.first]
                docs = np.arange(len(bounds) - 1)
                stream = np.insert(ids, bounds[1:], end_id).astype("<u4")
                ends = bounds[1:] + docs + 1
                owner = np.repeat(docs, found.counts)
                closed = _SENTENCE_END[found.data[found.end - 1]] if len(owner) else np.zeros(0, bool)
                sentences = after[1:][closed] + owner[closed]
                sentences = sentences[sentences > 0]
                places, penalty = cut_places(ends, sentences, length)
                cuts = best_cuts(places, penalty, length)
                stops = np.union1d(cuts, ends)
                begins = np.concatenate([[0], stops[:-1]])
                doc = np.searchsorted(ends, begins, "right")
                window = np.searchsorted(cuts, begins, "right")
                doc_begin, window_begin = np.concatenate([[0], ends])[doc], np.concatenate([[0], cuts])[window]
                raw = memoryview(stream).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(doc)),
                        pa.array(begins - doc_begin),
                        pa.array(stops - begins),
                        pa.array(crc, pa.int64()),
                        pa.array((ends - np.concatenate([[0], ends[:-1]]))[doc]),
                        pa.array(sequence + window),
                        pa.array(begins - window_begin),
                    ],
                    ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )
                sequence += len(cuts)

    return rows


def packed_pieces(docs: DataFrame, path: str, end_id: int = 1, length: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence.

    ``path`` names a tokenizer's file, the same on every machine; a document is its ids
    and ``end_id``.  ``sequence_id`` is unique, not gapless; ``offset`` is gapless in it.

    Defined cases.  A null or empty text is the closing id alone.  A text longer than a
    sequence is cut as often as needed.  Rows that repeat, or whose id is null, are packed
    like any other.  No documents give no rows.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_piece_rows(path, end_id, length), schema).withColumnRenamed("id", id_col)
