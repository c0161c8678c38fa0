"""BPE encoding and decoding by a deterministic automaton over tokens.

The automaton starts with one state that loops on every byte.  Merges are compiled in
order of priority, one gadget each: for the merge of u and v, the state that u leads to
is copied without its arc v, u is led to the copy, and every state with an arc u gets
an arc uv to where u, v led.  A string then has exactly one path, which is its
encoding.  All arcs of a token lead to one state, and copies share most arcs, so a
state is kept as its original, the arc it lacks and the merge that made it; whether it
has an arc follows by walking these tables.

A word is read through a trie of the tokens' bytes: from the state after each prefix,
each token that follows and is an arc reaches the state after a longer prefix.  Many
words take each step at once.  Decoding writes the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import Remembered, gather
from .words import Words, mix, parts, words_of

_U = np.uint64
#: Pieces longer than this are walked one by one.
LONG = 64
#: Pieces that take a step at once.
TOGETHER = 20_000

# How the tokenizer cuts a text before merging.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
_SPLIT = regex.compile(PRE_SPLIT)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """Tables compiled from a byte-level vocabulary and its merges."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        letters = byte_letters()
        size = max([*vocabulary.values(), *special.values()]) + 1
        self.labels = [b""] * size
        for token, i in vocabulary.items():
            self.labels[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            self.labels[i] = token.encode()
        self.special = special
        self.left, self.made = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.to = np.zeros(size, np.int64)
        self.origin, self.lacks, self.born = [0], [-1], [0]
        usable = np.zeros(size, bool)
        usable[[vocabulary[c] for c in letters]] = True
        for step, (first, second) in enumerate(merges, 1):
            u, v, w = vocabulary[first], vocabulary[second], vocabulary[first + second]
            state = int(self.to[u])
            if not (usable[u] and usable[v] and self._arc(state, v)):
                continue
            target = self.to[v]
            self.origin.append(state)
            self.lacks.append(v)
            self.born.append(step)
            self.to[u] = len(self.origin) - 1
            self.left[w], self.made[w], self.to[w], usable[w] = u, step, target, True
        self.origin, self.lacks, self.born = (np.array(x) for x in (self.origin, self.lacks, self.born))
        self._trie([(label, i) for i, label in enumerate(self.labels) if usable[i]])
        lengths = np.fromiter(map(len, self.labels), np.int64, size)
        self.label_bytes, self.label_length = np.frombuffer(b"".join(self.labels), np.uint8), lengths
        self.label_at = np.cumsum(lengths) - lengths

    def _arc(self, state: int, token: int) -> bool:
        """Whether a state has an arc."""
        while state:
            if self.made[token] >= self.born[state]:
                token = int(self.left[token])
            elif token == self.lacks[state]:
                return False
            else:
                state = int(self.origin[state])
        return True

    def _arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``_arc`` of many pairs."""
        pair, back = np.unique(state * len(self.labels) + token, return_inverse=True)
        state, token = pair // len(self.labels), pair % len(self.labels)
        out = np.ones(len(pair), bool)
        open_ = np.flatnonzero(state)
        while len(open_):
            s, t = state[open_], token[open_]
            later = self.made[t] >= self.born[s]
            lacks = ~later & (t == self.lacks[s])
            out[open_[lacks]] = False
            token[open_] = np.where(later, self.left[t], t)
            state[open_] = np.where(later, s, self.origin[s])
            open_ = open_[~lacks & (state[open_] > 0)]
        return out[back]

    def _trie(self, tokens: list[tuple[bytes, int]]) -> None:
        nodes: dict[bytes, int] = {b"": 0}
        for label, _ in sorted(tokens):
            for k in range(1, len(label) + 1):
                nodes.setdefault(label[:k], len(nodes))
        self.next = np.zeros((len(nodes), 256), np.int32)
        self.token = np.full(len(nodes), -1, np.int64)
        for prefix, node in nodes.items():
            if prefix:
                self.next[nodes[prefix[:-1]], prefix[-1]] = node
        for label, i in tokens:
            self.token[nodes[label]] = i

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each pre-split piece."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(lengths > LONG).tolist():
            out[i] = self._walk(pieces[i])
        order = np.argsort(-lengths, kind="stable")
        order = order[(lengths[order] <= LONG) & (lengths[order] > 0)]
        for begin in range(0, len(order), TOGETHER):
            some = order[begin : begin + TOGETHER]
            for i, ids in zip(some.tolist(), self._steps([pieces[i] for i in some.tolist()], lengths[some]), strict=True):
                out[i] = ids
        return out

    def _steps(self, pieces: list[bytes], lengths: np.ndarray) -> list[np.ndarray]:
        """Pieces of descending length, side by side."""
        n, most = len(pieces), int(lengths[0])
        raw = np.zeros((n, most + 1), np.uint8)
        inside = np.arange(most + 1) < lengths[:, None]
        raw[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        last, since = np.full((n, most + 1), -1, np.int64), np.zeros((n, most + 1), np.int64)
        reached = np.full((n, most + 1), -1, np.int64)
        reached[:, 0] = 0
        for j in range(most):
            rows = np.flatnonzero((reached[:, j] >= 0) & (lengths > j))
            node = np.zeros(len(rows), np.int64)
            for k in range(j, most):
                node = self.next[node, raw[rows, k]]
                go = (node > 0) & (lengths[rows] > k)
                rows, node = rows[go], node[go].astype(np.int64)
                if not len(rows):
                    break
                token = self.token[node]
                ends = np.flatnonzero((token >= 0) & (reached[rows, k + 1] < 0))
                at, token = rows[ends], token[ends]
                arc = self._arcs(reached[at, j], token)
                at, token = at[arc], token[arc]
                reached[at, k + 1], last[at, k + 1], since[at, k + 1] = self.to[token], token, j
        found, spots = [], lengths.copy()
        rows = np.arange(n)
        while len(rows):
            found.append((rows, last[rows, spots[rows]]))
            spots[rows] = since[rows, spots[rows]]
            rows = rows[spots[rows] > 0]
        row = np.concatenate([r for r, _ in found])
        ids = np.concatenate([i for _, i in found])
        depth = np.repeat(np.arange(len(found)), [len(r) for r, _ in found])
        order = np.lexsort((-depth, row))
        ids, edges = ids[order].astype(np.int32), [0, *np.cumsum(np.bincount(row, minlength=n)).tolist()]
        return [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    def _walk(self, piece: bytes) -> np.ndarray:
        n = len(piece)
        state, last, since = [-1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        state[0] = 0
        for j in range(n):
            if state[j] < 0:
                continue
            node = 0
            for k in range(j, n):
                node = int(self.next[node, piece[k]])
                if not node:
                    break
                token = int(self.token[node])
                if token >= 0 and state[k + 1] < 0 and self._arc(state[j], token):
                    state[k + 1], last[k + 1], since[k + 1] = int(self.to[token]), token, j
        ids = []
        while n:
            ids.append(last[n])
            n = since[n]
        return np.array(ids[::-1], np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """Labels of the arcs, one after the other."""
        return gather(self.label_bytes, self.label_at[ids], self.label_length[ids]).tobytes()

    def encode_text(self, text: str) -> np.ndarray:
        """Ids of a whole text: special tokens first, then pieces."""
        found: list[np.ndarray] = []
        cuts = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        for k, stretch in enumerate(cuts.split(text) if cuts else [text]):
            if k % 2:
                found.append(np.array([self.special[stretch]], np.int32))
            else:
                found += self.encode([p.encode() for p in _SPLIT.findall(stretch)])
        return np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int32)


@cache
def automaton(path: str) -> Automaton:
    """Compiled once per worker from a tokenizer's file."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in told["model"]["merges"]]
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    return Automaton({k: v for k, v in told["model"]["vocab"].items() if k not in special}, merges, special)


_SEEN: dict[str, Remembered] = {}
_GAPS: dict[tuple[str, bytes], np.ndarray] = {}


def _wide_space(data: np.ndarray) -> np.ndarray:
    """Where white space of more than one byte starts."""
    one, two = np.append(data[1:], 0), np.append(data[2:], [0, 0])[: len(data)]
    found = (data == 0xC2) & ((one == 0x85) | (one == 0xA0))
    found |= (data == 0xE1) & (one == 0x9A) & (two == 0x80)
    found |= (data == 0xE2) & (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF))
    found |= (data == 0xE2) & (one == 0x81) & (two == 0x9F)
    found |= (data == 0xE3) & (one == 0x80) & (two == 0x80)
    return np.flatnonzero(found)


def encoded(path: str, found: Words, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and each text's bounds among them.  ``bounds``: of texts in bytes.

    A text is cut into words with the blank before them, and other white space; no rule
    of the pre-split looks across such a cut.  Texts that hold special tokens or white
    space beyond ASCII are cut as a whole.
    """
    machine, seen = automaton(path), _SEEN.setdefault(path, Remembered())
    data, start, end, first = found.data, found.start, found.end, found.first
    owner = np.repeat(np.arange(len(bounds) - 1), found.counts)
    opens = np.zeros(len(start), bool)
    opens[first[:-1][found.counts > 0]] = True
    before = np.where(opens, bounds[owner], np.append(0, end[:-1])) if len(start) else start
    gap = start - before
    blank = (gap > 0) & (data[np.maximum(start - 1, 0)] == 0x20) if len(start) else np.zeros(0, bool)

    def encode(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        units, counts = [], []
        for a, b in zip((start[places] - blank[places]).tolist(), end[places].tolist(), strict=True):
            cut = _SPLIT.findall(data[a:b].tobytes().decode())
            units += cut
            counts.append(len(cut))
        ids = machine.encode([u.encode() for u in units])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return np.concatenate([*ids, np.zeros(0, np.int32)]), np.diff(edges)

    ids, count = seen.ids(mix(found.hashes() + blank.astype(_U)), encode)

    def space(raw: bytes) -> np.ndarray:
        key = path, raw
        if key not in _GAPS:
            made = machine.encode([raw])[0]
            if len(raw) > LONG:
                return made
            _GAPS[key] = made
        return _GAPS[key]

    # white space other than one blank before a word: where it goes among the ids, and its ids
    after = np.concatenate([[0], np.cumsum(count)])
    extra_at, extra = [], []
    odd = np.flatnonzero((gap > 1) | ((gap == 1) & ~blank))
    for k, a, b, led in zip(odd.tolist(), before[odd].tolist(), start[odd].tolist(), blank[odd].tolist(), strict=True):
        raw = data[a:b].tobytes()
        for piece in (raw[:-1],) if led else (raw[:-1], raw[-1:]):
            if piece:
                extra_at.append(int(after[k]))
                extra.append(space(piece))
    closing = np.where(found.counts > 0, end[np.maximum(first[1:] - 1, 0)] if len(end) else 0, bounds[:-1])
    for i in np.flatnonzero(bounds[1:] > closing).tolist():
        extra_at.append(int(after[first[i + 1]]))
        extra.append(space(data[closing[i] : bounds[i + 1]].tobytes()))
    text_bounds = after[first]
    if extra:
        place, sizes = np.array(extra_at), np.fromiter(map(len, extra), np.int64, len(extra))
        # a text's closing space lies before the next text's opening space: owners decide
        order_owner = np.concatenate([owner[odd].repeat(np.where(blank[odd], 1, np.where(gap[odd] > 1, 2, 1))), np.flatnonzero(bounds[1:] > closing)])
        order = np.lexsort((np.arange(len(place)), order_owner, place))
        place, sizes, extra = place[order], sizes[order], [extra[i] for i in order.tolist()]
        ids = np.insert(ids, np.repeat(place, sizes), np.concatenate(extra))
        text_bounds = text_bounds + np.concatenate([[0], np.cumsum(np.bincount(order_owner[order], sizes, len(bounds) - 1)).astype(np.int64)])
    whole = set(np.searchsorted(bounds, _wide_space(data), "right") - 1)
    raw = data.tobytes()
    for token in machine.special:
        at = raw.find(token.encode())
        while at >= 0:
            whole.add(int(np.searchsorted(bounds, at, "right")) - 1)
            at = raw.find(token.encode(), at + 1)
    if whole:
        each = [ids[a:b] for a, b in zip(text_bounds.tolist(), text_bounds[1:].tolist(), strict=False)]
        for i in sorted(whole):
            each[i] = machine.encode_text(raw[bounds[i] : bounds[i + 1]].decode())
        ids, text_bounds = np.concatenate(each), np.concatenate([[0], np.cumsum([len(e) for e in each])])
    return ids.astype(np.int32), text_bounds


def _coded_rows(path: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in batches:
            for part in parts(batch, "text"):
                found = words_of(part.column("text"))
                ids, bounds = encoded(path, found, found.bounds)
                coded = memoryview(ids.astype("<u4")).cast("B")
                decoded = memoryview(machine.decode(ids))
                edges = np.concatenate([[0], np.cumsum(machine.label_length[ids])])[bounds].tolist()
                at = bounds.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.diff(bounds)),
                        pa.array([hashlib.sha256(coded[4 * a : 4 * b]).hexdigest() for a, b in zip(at, at[1:], strict=False)]),
                        pa.array([hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(edges, edges[1:], strict=False)]),
                    ],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return rows


def _id_rows(path: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                found = words_of(part.column("text"))
                ids, bounds = encoded(path, found, found.bounds)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))], ["id", "ids"])

    return rows


def _text_rows(path: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in batches:
            texts = [machine.decode(v.values.to_numpy()).decode("utf-8", "replace") if v.is_valid else None for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return rows


def _named(docs: DataFrame, id_col: str, column: str, name: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(column).alias(name))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every text; ``path`` names a byte-level tokenizer's file, the same on every machine.

    Null and empty texts have no ids.  Ids equal the tokenizers library's, special tokens
    in a text included; rows that repeat or have a null id are encoded like any other.
    """
    kind = dict(docs.dtypes)[id_col]
    return _named(docs, id_col, text_col, "text").mapInArrow(_id_rows(path), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every array of ids; null for null.  Bytes that are no UTF-8 become U+FFFD."""
    kind = dict(rows.dtypes)[id_col]
    ids = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return ids.mapInArrow(_text_rows(path), f"id {kind}, text string").withColumnRenamed("id", id_col)


def coded_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text its number of ids, and digests of the ids and of the text decoded from them."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _named(docs, id_col, text_col, "text").mapInArrow(_coded_rows(path), schema).withColumnRenamed("id", id_col)
