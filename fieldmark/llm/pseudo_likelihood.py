"""LM scoring by masked pseudo-likelihood.

Every word is masked in turn and predicted from the words on both sides; a document's
score is the sum of the conditional log-probabilities.

*Network.*  Words are hashed to buckets and buckets belong to classes: the most frequent
have one of their own, the others share classes by bands of frequency.  A network reads
two words on either side of a gap, the nearer by their classes, the farther by groups of
classes, and gives a distribution over classes; times each word's share of its class it
is one over words.  It is trained on counts of windows over all documents, and tabulated.

*Words beside words.*  How often each word stands at each distance from each other, WINDOW
words to either side, is counted over all documents; these counts grow with the input.
Starting from the network's probability p, every neighbour, the farthest first, moves it
towards what was seen beside that neighbour: p := (n(word, offset, neighbour) + m p) /
(n(neighbour) + m).  What follows a neighbour, the end of a text included, so has a
probability of 1 in all.  The gap that is asked for is left out of these counts, and m is
the one of STRENGTHS under which all documents together are likeliest.

*Counting.*  No table of words goes to the driver or to every task.  Texts are cut into
chunks, and a chunk sends its distinct keys with their counts up a tree.  On each level a
node is a range of keys, F times narrower and for F times as many chunks as one level
below: it adds up what F nodes send it, and sends an Fth of its range to each of F nodes
above.  So rows and bytes of a level are in proportion to the input, a node holds about as
much as a chunk does, and a word of all chunks comes to a node once for each of its F
senders.  The top knows the sums over all chunks, which come down again the same way.
F is the least power of two, up to 2^FAN_BITS, that gives the fewest levels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .words import PART, Words, mix, parts, words_of

_U = np.uint64
#: log2 of the number of word buckets; classes; buckets with a class of their own; groups of classes; width of the hidden layer.
BITS, CLASSES, OWN, GROUPS, WIDTH = 16, 32, 20, 4, 48
#: What may stand on either side of a gap, the farther left first.
SIDES = (GROUPS + 1, CLASSES + 1, CLASSES + 1, GROUPS + 1)
CONTEXTS = SIDES[0] * SIDES[1] * SIDES[2] * SIDES[3]
#: Steps and rate of training.
STEPS, RATE = 300, 0.03
#: Neighbours to either side whose counts are kept; how much those counts must outweigh.
WINDOW, STRENGTHS = 2, (1.0, 8.0, 64.0, 512.0, 4096.0)
#: Bytes of text whose keys are looked up at once; log2 of the most senders of a node.
CHUNK, FAN_BITS = 8 << 20, 12
#: A key has so many bits more than the number of keys of all texts, so that about one in 2^SPARE meets another.
SPARE = 20
#: Words of a chunk that are scored at once; one longer text stands alone.
SLICE = 1 << 17


def _buckets(found: Words) -> np.ndarray:
    return (found.hashes(lower=True) >> _U(64 - BITS)).astype(np.int64)


def _contexts(own: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Context of each word; beyond a text's ends stands class CLASSES, group GROUPS."""
    context = np.zeros(len(own), np.int64)
    for offset, size in zip((-2, -1, 1, 2), SIDES, strict=True):
        beside = np.full(len(own), size - 1)
        far = abs(offset)
        gap, neighbour = (slice(far, None), slice(None, -far)) if offset < 0 else (slice(None, -far), slice(far, None))
        known = own[neighbour] if far == 1 else own[neighbour] * GROUPS // CLASSES
        beside[gap] = np.where(owner[gap] == owner[neighbour], known, size - 1)
        context = context * size + beside
    return context


def _gaps(found: Words, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and class of each word."""
    own = classes[_buckets(found)].astype(np.int64)
    return _contexts(own, np.repeat(np.arange(len(found.counts)), found.counts)), own


def _stored(rows: list[pa.RecordBatch]) -> bytes:
    """Ids and texts of a chunk, compressed."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(pa.Table.from_batches(rows).combine_chunks())
    return out.getvalue().to_pybytes()


def _documents(stored: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(stored.as_buffer()).read_all()


def _chunked(size: int) -> Callable:
    """A row for each chunk, of ``size`` bytes of text or one longer text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, taken = TaskContext.get().partitionId() << 32, 0, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([_stored(taken)], pa.binary())], ["chunk", "docs"])

        for batch in batches:
            for part in parts(batch, "text", min(size, PART)):
                more = (pc.sum(pc.binary_length(part.column("text"))).as_py() or 0) + 64 * part.num_rows
                if taken and held + more > size:
                    yield row()
                    chunk, held, taken = chunk + 1, 0, []
                held += more
                taken.append(part)
        if taken:
            yield row()

    return rows


def _counted(chunks: DataFrame, count: Callable[[Words], np.ndarray], size: int) -> np.ndarray:
    """Sum over all texts of small vectors of counts, ``size`` long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for stored in batch.column("docs"):
                for part in _documents(stored).to_batches():
                    for piece in parts(part, "text"):
                        found = words_of(piece.column("text"))
                        if len(found.start):
                            total += count(found)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["k", "n"])

    counts = chunks.select("docs").mapInArrow(rows, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toArrow()  # ``size`` rows at most
    out = np.zeros(size, np.int64)
    out[counts["k"].to_numpy()] = counts["n"].to_numpy()
    return out


def bucket_classes(counts: np.ndarray) -> np.ndarray:
    """A class for every bucket: own ones for the most frequent, then bands of equal mass."""
    order = np.argsort(-counts, kind="stable")
    out = np.empty(len(counts), np.int64)
    out[order[:OWN]] = np.arange(OWN)
    rest = order[OWN:]
    mass = np.cumsum(counts[rest])
    total = max(int(mass[-1]), 1)
    out[rest] = OWN + np.minimum((mass - counts[rest]) * (CLASSES - OWN) // total, CLASSES - OWN - 1)
    return out


class WindowNetwork:
    """Four embeddings, one per place in the window, a hidden layer and a softmax over classes."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        places = [rng.normal(0, 0.3, (size, WIDTH)) for size in SIDES]
        self.weights = [*places, np.zeros(WIDTH), rng.normal(0, 0.1, (WIDTH, CLASSES)), np.zeros(CLASSES)]

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and log-probabilities of every context."""
        *places, bias, out, base = self.weights
        left = (places[0][:, None] + places[1] + bias).reshape(-1, WIDTH)
        right = (places[2][:, None] + places[3]).reshape(-1, WIDTH)
        hidden = np.tanh(left[:, None] + right).reshape(-1, WIDTH)
        logits = hidden @ out + base
        logits -= logits.max(axis=1, keepdims=True)
        return hidden, logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def train(self, counts: np.ndarray, steps: int = STEPS, rate: float = RATE) -> list[float]:
        """``counts``: of contexts x masked classes.  Loss per masked word after each step."""
        total = max(counts.sum(), 1.0)
        target, weight = counts / total, counts.sum(axis=1, keepdims=True) / total
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        losses = []
        for step in range(1, steps + 1):
            hidden, logs = self.forward()
            losses.append(float(-(target * logs).sum()))
            error = np.exp(logs) * weight - target
            back = (error @ self.weights[5].T) * (1 - hidden**2)
            grid = back.reshape(*SIDES, WIDTH)
            left, right = grid.sum(axis=(2, 3)), grid.sum(axis=(0, 1))
            slopes = [left.sum(axis=1), left.sum(axis=0), right.sum(axis=1), right.sum(axis=0), back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                self.weights[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-10)
        return losses


def _keys(found: Words, bits: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """A key for each word, then one for each pair of words at each distance; of those pairs the distance and the places of the first words."""
    hashes = found.hashes(lower=True)
    owner = np.repeat(np.arange(len(found.counts), dtype=np.int32), found.counts)
    pairs = [(far, np.flatnonzero(owner[far:] == owner[:-far]).astype(np.int32)) for far in range(WINDOW, 0, -1)]
    keys = np.empty(len(hashes) + sum(len(a) for _, a in pairs), _U)
    at = len(hashes)
    keys[:at] = mix(hashes)
    for far, a in pairs:
        keys[at : at + len(a)] = mix(hashes[a] * _U(0x9FB21C651E98DF25) + hashes[a + far] * _U(2 * far + 1))
        at += len(a)
    keys >>= _U(64 - bits)
    return keys, pairs


def _news(ordered: np.ndarray) -> np.ndarray:
    """Which of sorted values differ from the one before."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return new


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each is there; ``keys`` is sorted where it lies."""
    keys.sort()
    first = np.flatnonzero(_news(keys))
    return keys[first], np.diff(first, append=len(keys))


def _packed(values: np.ndarray, kind: type) -> bytes:
    """Byte by byte of all values, so that leading zeros lie together, compressed."""
    raw = values.astype(kind).view(np.uint8).reshape(len(values), -1).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(packed: bytes, kind: type) -> np.ndarray:
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd")
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


#: ``slot`` and ``range`` name a node, ``sender`` and ``place`` who asks and which part of its sorted keys.
_ASKED = "slot bigint, range bigint, sender bigint, place int, keys binary, counts binary"
_ANSWERED = "slot bigint, range bigint, place int, counts binary"


def _sent(keys: np.ndarray, counts: np.ndarray, slot: int, sender: int, node: int, fan: int, low: int) -> pa.Table:
    """Rows for the nodes above: sorted ``keys`` of range ``node`` cut by the ``fan`` bits above the lowest ``low``."""
    cuts = np.searchsorted(keys, (np.arange(1, 1 << fan, dtype=np.uint64) + _U(node << fan)) << _U(low))
    cuts = np.concatenate([[0], cuts, [len(keys)]])
    some = np.flatnonzero(np.diff(cuts)).tolist()
    blobs = [(_packed(np.diff(keys[cuts[i] : cuts[i + 1]], prepend=_U(0)), np.uint64), _packed(counts[cuts[i] : cuts[i + 1]], np.int64)) for i in some]
    n = len(some)
    arrays = [
        pa.array([slot] * n, pa.int64()), pa.array([(node << fan) + i for i in some], pa.int64()), pa.array([sender] * n, pa.int64()),
        pa.array(some, pa.int32()), pa.array([k for k, _ in blobs], pa.binary()), pa.array([c for _, c in blobs], pa.binary()),
    ]
    return pa.Table.from_arrays(arrays, names=["slot", "range", "sender", "place", "keys", "counts"])


def _received(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a node with their sums, and of each row of ``table`` the places of its keys and where they end."""
    each = [np.cumsum(_unpacked(x, np.uint64), dtype=_U) for x in table["keys"].to_pylist()]
    keys, back = np.unique(np.concatenate(each), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, back, np.concatenate([_unpacked(x, np.int64) for x in table["counts"].to_pylist()]))
    return keys, sums, back, np.cumsum([len(x) for x in each])


def _asked(slots: int, bits: int, fan: int) -> Callable:
    """What chunks send to the lowest nodes."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, stored in zip(batch.column("chunk").to_pylist(), batch.column("docs"), strict=True):
                keys, counts = _distinct(_keys(words_of(_texts(_documents(stored))), bits)[0])
                slot = int(mix(np.array([chunk], _U))[0]) % slots
                yield from _sent(keys, counts, slot >> fan, chunk, 0, fan, bits - fan).to_batches()

    return ask


def _passed_up(fan: int, low: int) -> Callable:
    """What a node sends to the nodes above it, once it has added up its rows."""

    def up(table: pa.Table) -> pa.Table:
        slot, node = table["slot"][0].as_py(), table["range"][0].as_py()
        keys, sums, _, _ = _received(table)
        return _sent(keys, sums, slot >> fan, slot, node, fan, low)

    return up


def _told(answers: pa.Table) -> np.ndarray:
    """Sums of all sorted keys of a sender, from the answers to its parts."""
    return np.concatenate([_unpacked(x, np.int64) for x in answers.sort_by("place")["counts"].to_pylist()])


def _answers(table: pa.Table, fan: int, answers: pa.Table | None = None) -> pa.Table:
    """For each of a node's senders the sums over all chunks: its own at the top, else those that ``answers`` tell.

    A sender goes by its slot, or its chunk on the lowest level.
    """
    keys, sums, back, ends = _received(table)
    if answers is not None:
        sums = _told(answers)
    if len(sums) != len(keys):
        raise RuntimeError("the answers are not those of this node's keys")
    blobs = [_packed(x, np.int64) for x in np.split(sums[back], ends[:-1])]
    arrays = [table["sender"], pc.shift_right(table["range"], fan), table["place"], pa.array(blobs, pa.binary())]
    return pa.Table.from_arrays(arrays, names=["slot", "range", "place", "counts"])


def _top(fan: int) -> Callable:
    def answer(table: pa.Table) -> pa.Table:
        return _answers(table, fan)

    return answer


def _passed_down(fan: int) -> Callable:
    def answer(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _answers(table, fan, answers)

    return answer


def _summed(asked: DataFrame, depth: int, fan: int, bits: int) -> DataFrame:
    """Answers to all that chunks ask for, by a tree of ``depth`` levels; ``slot`` is the chunk."""
    levels = [asked]
    for level in range(1, depth):
        levels[-1] = settle(levels[-1])  # it is read on the way up and down
        levels.append(levels[-1].groupBy("slot", "range").applyInArrow(_passed_up(fan, bits - fan * (level + 1)), _ASKED))
    answers = levels.pop().groupBy("slot", "range").applyInArrow(_top(fan), _ANSWERED)
    while levels:
        answers = levels.pop().groupBy("slot", "range").cogroup(answers.groupBy("slot", "range")).applyInArrow(_passed_down(fan), _ANSWERED)
    return answers


def _texts(table: pa.Table) -> pa.Array:
    return pa.concat_arrays([x.cast(pa.large_string()) for x in table["text"].chunks] or [pa.array([], pa.large_string())])


def _seen(keys: np.ndarray, told: np.ndarray) -> np.ndarray:
    """The sum that ``told`` has for each key; ``told`` goes by distinct keys, ascending.  Uses ``keys`` up."""
    order = np.argsort(keys).astype(np.uint32 if len(keys) < 1 << 32 else np.int64)
    keys[:] = keys[order]
    new = _news(keys)
    if len(told) != np.count_nonzero(new):
        raise RuntimeError("the answers are not those of this chunk's keys")
    seen, before = keys.view(np.float64), -1  # in the place of the keys, whose order is known
    for begin in range(0, len(order), SLICE):
        some = order[begin : begin + SLICE]
        place = np.cumsum(new[begin : begin + SLICE]) + before
        seen[some], before = told[place], int(place[-1])
    return seen


def _scored(classes: np.ndarray, table: np.ndarray, mass: np.ndarray, bits: int) -> Callable:
    """Scores of a chunk's texts under each of STRENGTHS, some texts at a time.  ``mass``: words of each class."""

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        docs = _documents(chunk["docs"][0])
        found = words_of(_texts(docs))
        ids, n, first, counts = docs["id"], len(found.start), found.first, found.counts
        del docs
        sums = [np.zeros(len(counts)) for _ in STRENGTHS]
        if n:
            own = classes[_buckets(found)].astype(np.uint8)
            keys, pairs = _keys(found, bits)
            del found  # from here on words are places
            seen = _seen(keys, _told(answers))
            starts = np.cumsum([n, *[len(a) for _, a in pairs]])
            text = 0
            while text < len(counts):
                stop = max(text + 1, int(np.searchsorted(first, first[text] + SLICE, "right")) - 1)
                low, high = int(first[text]), int(first[stop])
                owner = np.repeat(np.arange(stop - text), counts[text:stop])
                context, alone = _contexts(own[low:high].astype(np.int64), owner), seen[low:high]
                of_class = own[low:high]
                network = np.exp(table[context, of_class].astype(np.float64)) * alone / mass[of_class]
                beside = []
                for start, (far, a) in zip(starts.tolist(), pairs, strict=False):
                    begin, end = np.searchsorted(a, [low, high]).tolist()
                    beside.append((far, a[begin:end] - low, seen[start + begin : start + end]))
                for total, strength in zip(sums, STRENGTHS, strict=True):
                    p = network.copy()
                    for far, a, together in beside:
                        for gap, neighbour in ((a + far, a), (a, a + far)):
                            p[gap] = (together - 1 + strength * p[gap]) / (alone[neighbour] - 1 + strength)
                    total[text:stop] = np.bincount(owner, np.log(p), stop - text)
                text = stop
        names = ["id", "n_tokens", *[f"s{i}" for i in range(len(STRENGTHS))]]
        return pa.Table.from_arrays([ids, pa.array(counts), *map(pa.array, sums)], names=names)

    return score


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, fan_bits: int = FAN_BITS) -> DataFrame:
    """(id, n_tokens, log_likelihood, mean_log_likelihood) of every text, under a model trained on all texts.

    Defined cases.  A text without words, or null, has log_likelihood 0 and a null mean.
    Rows that repeat count and train as often.  Ids may be null.  Words are taken whole,
    A-Z as a-z; the ends of a text are context of their own.  A text longer than a chunk
    is a chunk by itself.  Other columns are not read.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = settle(rows.mapInArrow(_chunked(chunk), "chunk bigint, docs binary"))  # chunks must stay as they are
    counts = _counted(rows, lambda found: np.bincount(_buckets(found), minlength=1 << BITS), 1 << BITS)
    classes = bucket_classes(counts)

    def seen(found: Words) -> np.ndarray:
        context, own = _gaps(found, classes)
        return np.bincount(context * CLASSES + own, minlength=CONTEXTS * CLASSES)

    network = WindowNetwork()
    network.train(_counted(rows, seen, CONTEXTS * CLASSES).reshape(CONTEXTS, CLASSES).astype(float))
    table = network.forward()[1].astype(np.float32)
    mass = np.bincount(classes, counts, CLASSES)
    wide = max(1, (rows.count() - 1).bit_length())  # log2 of the number of chunks
    depth = -(-wide // fan_bits)
    fan = -(-wide // depth)
    keys = int(counts.sum()) * (1 + WINDOW)
    bits = min(64, max(keys.bit_length() + SPARE, fan * depth))
    asked = rows.mapInArrow(_asked(1 << (fan * depth), bits, fan), _ASKED)
    answered = _summed(asked, depth, fan, bits).withColumnRenamed("slot", "chunk")
    sums = [f"s{i}" for i in range(len(STRENGTHS))]
    kinds = ", ".join(f"{s} double" for s in sums)
    score = _scored(classes, table, mass, bits)
    scored = settle(rows.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(score, f"id {kind}, n_tokens bigint, {kinds}"))
    totals = scored.agg(*[F.coalesce(F.sum(s), F.lit(0.0)).alias(s) for s in sums]).first()
    best = F.col(max(sums, key=lambda s: totals[s]))
    mean = F.when(F.col("n_tokens") > 0, best / F.col("n_tokens"))
    return scored.select(F.col("id").alias(id_col), "n_tokens", F.round(best, 4).alias("log_likelihood"), F.round(mean, 6).alias("mean_log_likelihood"))
