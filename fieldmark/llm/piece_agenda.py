"""SentencePiece encoding and decoding for vocabularies of merge type.

Encoding keeps an agenda of adjacent symbols that together are a piece, ordered by the
piece's score and, of equal scores, from the left.  The first of the agenda is merged, its
new neighbours enter, until the agenda is empty.  Symbols left without a piece fall back
to their bytes.

A merge never crosses two characters that stand side by side in no piece of the
vocabulary.  Texts are cut there, which is exact, and a stretch between cuts is encoded
when it is first seen.  New stretches of an Arrow batch have their agendas worked off
together, one merge of each in a round; a stretch of over ``LONG`` characters has a heap
of its own.  The same stretches then go through the sentencepiece library, and a
difference ends the job.

Empty and null texts have the end id alone.  Nothing depends on ids or other columns, so
rows that repeat or have a null id are encoded like any other.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import Remembered, gather
from .words import Words, parts

#: What stands for a blank inside pieces (fixed value).
BLANK = "▁"
#: Characters of a stretch that is worked off in rounds with others.
LONG = 64
#: Rank of a pair that is no piece.
_NONE = (1 << 30) - 1
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("fieldmark-each-byte", _each_byte)


class Vocabulary:
    """Pieces with the order of their scores, and which pairs of symbols make one."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if (
            proto.trainer_spec.model_type != model.TrainerSpec.BPE
            or rules.precompiled_charsmap
            or rules.remove_extra_whitespaces
            or not (rules.add_dummy_prefix and rules.escape_whitespaces and proto.trainer_spec.byte_fallback)
            or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        ):
            raise ValueError("wanted: merge type, identity rule, blank in front, byte fallback, no pieces of a user's own")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = self.library.eos_id()
        names = {p.piece.replace(BLANK, " "): i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        scores = np.array([p.score for p in proto.pieces], np.float32)
        rank = np.unique(-scores, return_inverse=True)[1]
        self.bytes = np.zeros(256, np.int64)
        labels, self.silent = [], np.zeros(len(proto.pieces), bool)
        for i, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
                labels.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == _NORMAL:
                labels.append(p.piece.replace(BLANK, " ").encode())
            else:
                self.silent[i] = p.type == _CONTROL
                labels.append(b"" if p.type == _CONTROL else proto.trainer_spec.unk_surface.encode())
        self.plain = np.array([p.type == _NORMAL for p in proto.pieces])
        self.label = np.frombuffer(b"".join(labels), np.uint8)
        self.label_size = np.array([len(x) for x in labels], np.int64)
        self.label_at = np.cumsum(self.label_size) - self.label_size

        # a character that is no piece, but part of one, is a symbol too
        letters = sorted({c for name in names for c in name})
        symbols, more = dict(names), len(proto.pieces)
        for c in letters:
            if c not in symbols:
                symbols[c], more = more, more + 1
        self.letters = np.array([ord(c) for c in letters], np.int64)
        self.letter_symbol = np.array([symbols[c] for c in letters], np.int64)
        self.first_without_piece = len(proto.pieces)

        found = {
            (symbols[name[:k]] << 32) + symbols[name[k:]]: (int(rank[i]), i)
            for name, i in names.items()
            for k in range(1, len(name))
            if name[:k] in symbols and name[k:] in symbols
        }
        self.pairs = found
        self.pair_keys = np.array(sorted(found), np.int64)
        self.pair_rank = np.array([found[k][0] for k in self.pair_keys.tolist()], np.int64)
        self.pair_makes = np.array([found[k][1] for k in self.pair_keys.tolist()], np.int64)

        beside = {(ord(a) << 32) + ord(b) for name in names for a, b in zip(name, name[1:], strict=False)}
        self.beside = np.array(sorted(beside), np.int64)
        self.beside_low = np.zeros((256, 256), bool)
        for key in beside:
            a, b = key >> 32, key & 0xFFFFFFFF
            if a < 256 and b < 256:
                self.beside_low[a, b] = True
        alone = [c for c in map(chr, range(128)) if not any(c in name for name in names if len(name) > 1)]
        self.alone = alone[0] if alone else None

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two characters ever stand side by side in a piece."""
        out = self.beside_low[np.minimum(left, 255), np.minimum(right, 255)]
        wide = np.flatnonzero((left > 255) | (right > 255))
        keys = (left[wide].astype(np.int64) << 32) + right[wide]
        slot = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        out[wide] = self.beside[slot] == keys
        return out

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols."""
        keys = (left << 32) + right
        slot = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[slot] == keys
        return np.where(hit, self.pair_rank[slot], _NONE), np.where(hit, self.pair_makes[slot], -1)

    def symbols(self, code: np.ndarray) -> np.ndarray:
        """The symbol of each character; -1 minus the character where no piece has it."""
        code = code.astype(np.int64)
        slot = np.minimum(np.searchsorted(self.letters, code), len(self.letters) - 1)
        return np.where(self.letters[slot] == code, self.letter_symbol[slot], -1 - code)

    def worked_off(self, symbol: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of many stretches, which begin at ``first``, and how many each has."""
        n, word = len(first), np.arange(len(first))
        last = np.append(first[1:], len(symbol)) - 1
        rank, makes = self.look(symbol, np.append(symbol[1:], -1))
        rank[last] = _NONE
        done, done_word, done_count = [], [], []
        while len(first):
            best = np.minimum.reduceat((rank << 32) + np.arange(len(rank)), first)
            live = best >> 32 < _NONE
            if not live.all():
                size = np.diff(np.append(first, len(symbol)))
                kept = np.repeat(live, size)
                done.append(symbol[~kept])
                done_word.append(word[~live])
                done_count.append(size[~live])
                symbol, rank, makes, word = symbol[kept], rank[kept], makes[kept], word[live]
                gone = np.cumsum(np.where(live, 0, size))
                best, first = best[live] - gone[live], (np.cumsum(size * live) - size)[live]
                if not len(first):
                    break
            at = best & 0xFFFFFFFF
            symbol[at] = makes[at]
            kept = np.ones(len(symbol), bool)
            kept[at + 1] = False
            symbol, rank, makes = symbol[kept], rank[kept], makes[kept]
            step = np.arange(len(first))
            at, first = at - step, first - step
            end = np.append(first[1:], len(symbol)) - 1
            for place, inside in ((at, at < end), (at - 1, at > first)):
                here = place[inside]
                rank[here], makes[here] = self.look(symbol[here], symbol[here + 1])
            rank[end] = _NONE
        counts, owner = np.concatenate([*done_count, np.zeros(0, np.int64)]), np.concatenate([*done_word, np.zeros(0, np.int64)])
        order = np.argsort(owner)
        at = np.cumsum(counts) - counts
        assert len(owner) == n
        return gather(np.concatenate([*done, np.zeros(0, np.int64)]), at[order], counts[order]), counts[order]

    def worked_off_alone(self, symbol: list[int]) -> list[int]:
        """Symbols left of one stretch, from a heap."""
        n, pairs = len(symbol), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def enter(left: int, right: int) -> None:
            found = pairs.get((symbol[left] << 32) + symbol[right])
            if found:
                agenda.append((found[0], left, right, symbol[left], symbol[right]))

        for i in range(n - 1):
            enter(i, i + 1)
        heapq.heapify(agenda)
        gone = [False] * n
        while agenda:
            _, left, right, a, b = heapq.heappop(agenda)
            if gone[left] or gone[right] or symbol[left] != a or symbol[right] != b or after[left] != right:
                continue
            symbol[left], gone[right] = pairs[(a << 32) + b][1], True
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            for x, y in ((before[left], left), (left, after[left])):
                if x >= 0 and y < n:
                    found = pairs.get((symbol[x] << 32) + symbol[y])
                    if found:
                        heapq.heappush(agenda, (found[0], x, y, symbol[x], symbol[y]))
        return [s for s, out in zip(symbol, gone, strict=True) if not out]

    def encode_stretches(self, code: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches of characters, in a row, and how many each has."""
        symbol = self.symbols(code)
        size = np.diff(np.append(first, len(code)))
        long = np.flatnonzero(size > LONG)
        if len(long):
            apart = {int(i): np.array(self.worked_off_alone(symbol[first[i] : first[i] + size[i]].tolist()), np.int64) for i in long}
            short = np.flatnonzero(size <= LONG)
            kept = np.repeat(size <= LONG, size)
            left, counts = self.worked_off(symbol[kept], np.cumsum(size[short]) - size[short])
            at = np.cumsum(counts) - counts
            pieces = {int(i): left[a : a + c] for i, a, c in zip(short, at.tolist(), counts.tolist(), strict=True)} | apart
            rows = [pieces[i] for i in range(len(first))]
            left, counts = np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
        else:
            left, counts = self.worked_off(symbol, first)
        bare = np.flatnonzero((left < 0) | (left >= self.first_without_piece))
        if not len(bare):
            return left, counts
        letter = dict(zip(self.letter_symbol.tolist(), self.letters.tolist(), strict=True))
        made = [self.bytes[list(chr(-1 - s if s < 0 else letter[s]).encode())] for s in left[bare].tolist()]
        sizes = np.ones(len(left), np.int64)
        sizes[bare] = [len(m) for m in made]
        ids = np.repeat(left, sizes)
        begins = np.cumsum(sizes) - sizes
        for i, m in zip(begins[bare].tolist(), made, strict=True):
            ids[i : i + len(m)] = m
        owner = np.repeat(np.arange(len(counts)), counts)
        return ids, np.bincount(owner, sizes, len(counts)).astype(np.int64)

    def check(self, stretches: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """The library must give the same ids for the same stretches.

        They are laid into one text with a character between them that no merge crosses;
        without such a character each goes in alone, in front of which the library sets a
        blank, so that only those that begin with one can be compared.
        """
        if self.alone is None:
            at = (np.cumsum(counts) - counts).tolist()
            for s, a, c in zip(stretches, at, counts.tolist(), strict=True):
                if len(s) > 1 and s[0] == " " and self.library.encode(s[1:], num_threads=1) != ids[a : a + c].tolist():
                    raise RuntimeError(f"the library encodes {s!r} in another way")
            return
        want = np.array(self.library.encode(self.alone + self.alone.join(stretches), num_threads=1), np.int64)
        between = np.array(self.library.encode(self.alone, num_threads=1), np.int64)  # the blank in front, and the character
        own = between[1:]
        places = np.repeat(np.cumsum(counts) - counts, len(own))
        got = np.concatenate([between[:1], np.insert(ids, places, np.tile(own, len(counts)))])
        if not np.array_equal(want, got):
            raise RuntimeError("the library encodes a stretch of this batch in another way")

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of a row of ids, in bytes that need not be UTF-8.

        The blank set in front goes if a piece brings it before anything else is out.
        """
        ids = np.asarray(ids, np.int64)
        data = gather(self.label, self.label_at[ids], self.label_size[ids]).tobytes()
        spoken = np.flatnonzero(~self.silent[ids])
        if len(spoken) and self.plain[ids[spoken[0]]] and data[:1] == b" ":
            return data[1:]
        return data

    def text(self, ids: np.ndarray) -> str:
        """Text of a row of ids; each byte that is no UTF-8 becomes U+FFFD, and a control id parts the bytes beside it."""
        ids, data = np.asarray(ids, np.int64), self.decode(ids)
        silent = np.flatnonzero(self.silent[ids[:-1]])
        if not len(silent):
            return data.decode("utf-8", "fieldmark-each-byte")
        after = np.cumsum(self.label_size[ids])
        cuts = np.maximum(after[silent] - (after[-1] - len(data)), 0).tolist()
        return "".join(data[a:b].decode("utf-8", "fieldmark-each-byte") for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _memory(path: str) -> Remembered:
    return Remembered()


def encoded(path: str, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the texts' bounds among them; each text closes with the end id."""
    words = vocabulary(path)
    led = [" " + t if t else "" for t in texts]
    joined = "".join(led).replace(BLANK, " ")
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    text_bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, led), np.int64, len(led)))])
    ends_after = np.arange(len(texts)) + 1
    if not len(code):
        return np.full(len(texts), words.end, np.int32), np.concatenate([[0], ends_after])
    cut = np.ones(len(code), bool)
    cut[1:] = ~words.joined(code[:-1], code[1:])
    cut[text_bounds[:-1][text_bounds[:-1] < len(code)]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(code))
    data = np.frombuffer(joined.encode(), np.uint8)
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(start, text_bounds)
    spans = Words(data, lead[start], lead[end], first, lead[text_bounds])

    def encode(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = end[new] - start[new]
        at = np.cumsum(size) - size
        ids, counts = words.encode_stretches(gather(code, start[new], size), at)
        words.check([joined[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)], ids, counts)
        return ids, counts

    ids, counts = _memory(path).ids(spans.hashes(), encode)
    bounds = np.concatenate([[0], np.cumsum(counts)])[first]
    ids = np.insert(ids, bounds[1:], words.end)
    return ids.astype(np.int32), bounds + np.concatenate([[0], ends_after])


def _texts(part: pa.RecordBatch) -> list[str | None]:
    return part.column("text").to_pylist()


def _digest_rows(path: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        names = [str(i) for i in range(len(words.label_size))]
        for batch in batches:
            for part in parts(batch, "text"):
                ids, bounds = encoded(path, _texts(part))
                coded, decoded = [], []
                for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
                    own = ids[a:b]
                    coded.append(hashlib.sha256(" ".join([names[i] for i in own.tolist()]).encode()).hexdigest())
                    decoded.append(hashlib.sha256(words.text(own).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(bounds)), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return rows


def _id_rows(path: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, "text"):
                ids, bounds = encoded(path, _texts(part))
                made = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("id"), made], ["id", "ids"])

    return rows


def _text_rows(path: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            texts = [words.text(v.values.to_numpy()) if v.is_valid else None for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return rows


def _compared_rows(path: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = vocabulary(path).library
        for batch in batches:
            for part in parts(batch, "text"):
                texts = [t or "" for t in _texts(part)]
                ids, bounds = encoded(path, texts)
                want = library.encode(texts, num_threads=1, add_eos=True)
                same = [ids[a:b].tolist() == w for a, b, w in zip(bounds.tolist(), bounds[1:].tolist(), want, strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(same, pa.bool_())], ["id", "same"])

    return rows


def _named(docs: DataFrame, id_col: str, column: str, name: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(column).alias(name))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) of every whole text, the end id last; ``path`` names a model's file, the same on every machine."""
    kind = dict(docs.dtypes)[id_col]
    return _named(docs, id_col, text_col, "text").mapInArrow(_id_rows(path), f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every array of ids; null for null.  Each byte that is no UTF-8 becomes U+FFFD."""
    kind = dict(rows.dtypes)[id_col]
    ids = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return ids.mapInArrow(_text_rows(path), f"id {kind}, text string").withColumnRenamed("id", id_col)


def compared(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, same): whether the library gives every whole text the same ids."""
    kind = dict(docs.dtypes)[id_col]
    return _named(docs, id_col, text_col, "text").mapInArrow(_compared_rows(path), f"id {kind}, same boolean").withColumnRenamed("id", id_col)


def coded_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text its number of ids, and digests of the ids and of the text decoded from them."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _named(docs, id_col, text_col, "text").mapInArrow(_digest_rows(path), schema).withColumnRenamed("id", id_col)
