"""BPE automaton and packing, against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldmark.llm import bpe_automaton as B
from fieldmark.llm import packing as P
from fieldmark.llm.queries import tokenizer_path
from fieldmark.llm.words import words_of

tokenizers = pytest.importorskip("tokenizers")
BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "\n", "a", "hello world", "don't we'll\n\n  x  y \n z\t\tq ", "x<|endoftext|> y <|endoftext|>\n", "日本語 é ñ", "a" * 300, "        \n",
    "\n\n\nab\n", " lead", "trail ", "123 4567 12ab!! ...,,, ''s 's", " a\x1cb \x1f c\x85d  e　f", "A<|startoftext|>B", "<|endoftext|>", "ab" * 5000,
]


def library(path, texts):
    made = tokenizers.Tokenizer.from_file(path)
    return [e.ids for e in made.encode_batch([t or "" for t in texts], add_special_tokens=False)], made


def automaton_ids(texts):
    found = words_of(pa.array(texts, pa.string()))
    ids, bounds = B.encoded(BYTES, found, found.bounds)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]


def test_ids_equal_the_library():
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice("ab'st e\n \t.,!1é 日< ") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    assert automaton_ids(texts) == library(BYTES, texts)[0]


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=40))
def test_any_text_equals_the_library_and_comes_back(text):
    ids = automaton_ids([text, "x", text])
    assert ids[0] == ids[2] == library(BYTES, [text])[0][0]
    assert B.automaton(BYTES).decode(np.array(ids[0], np.int64)).decode() == text


def test_encode_and_decode_tables(spark):
    docs = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids int")
    coded = B.encode(docs, BYTES)
    back = {r.doc_id: r.text for r in B.decode(coded, BYTES).collect()}
    assert back == {i if i else None: t or "" for i, t in enumerate(TEXTS)}
    assert B.encode(docs.limit(0), BYTES).count() == B.coded_digests(docs.limit(0), BYTES).count() == 0


def price(places, penalty, a, b, length):
    """Padding of a window from a to b, and what its end costs."""
    size, full = b - a, length - (b - a)
    padding = min(full, P.SHORT if size < length else 0) if size & (size - 1) == 0 else full
    return padding + int(penalty[np.searchsorted(places, b)])


def test_cuts_are_of_least_cost():
    rng = np.random.default_rng(2)
    for _ in range(30):
        total, length = int(rng.integers(10, 60)), 16
        places = np.unique(np.append(rng.integers(1, total, 20), [*range(8, total, 8), total]))
        penalty = rng.integers(0, 30, len(places))
        cuts = P.best_cuts(places, penalty, length).tolist()
        windows = list(zip([0, *cuts], cuts, strict=False))
        assert cuts[-1] == total and all(b - a <= length for a, b in windows)
        best = {0: 0}
        for p in places.tolist():
            best[p] = min(best[q] + price(places, penalty, q, p, length) for q in best if p - q <= length)
        assert sum(price(places, penalty, a, b, length) for a, b in windows) == best[total]


def test_pieces_hold_every_id_once(spark):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice(["word", "Other.", "x!", "é", "longerword"]) for _ in range(rng.randint(1, 4000))) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, offset int").repartition(3)
    rows = P.packed_pieces(docs, WORDS).collect()
    ids = [np.array([*e, 1], "<u4") for e in library(WORDS, texts)[0]]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, own in enumerate(ids):
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(own) and zlib.crc32(own[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(own)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 2048 - at if at & (at - 1) else 0
    assert padding < 0.02 * sum(map(len, ids))


def test_packing_edges(spark):
    docs = spark.createDataFrame([(None, None), (None, None), (1, "")], "doc_id long, text string")
    rows = P.packed_pieces(docs, WORDS).collect()
    assert [(r.length, r.doc_tokens) for r in rows] == [(1, 1)] * 3
    assert P.packed_pieces(docs.limit(0), WORDS).count() == 0


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, made):
        self.made, self.texts = made, 0

    def __getattr__(self, name):
        def call(texts, **options):
            self.texts += len(texts)
            return getattr(self.made, name)(texts, **options)

        return call


def test_words_are_encoded_many_in_a_text():
    rng = random.Random(11)
    words = ["don't", "x<|endoftext|>", "İb", "é", "éa,", "क़a", "日本語.", "12a", "...", "a.b", "　", "q\x85r", "a" * 3000]
    words += ["".join(rng.choice("abcdefghiéß") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ",", ".", "'s", "-"]) for _ in range(3000)]
    rng.shuffle(words)
    made = tokenizers.Tokenizer.from_file(WORDS)
    made.no_truncation()
    counting = Counting(made)
    ids, count = P._joined_ids(counting, P._word_ends(made), words)
    wanted = [e.ids for e in made.encode_batch(words, add_special_tokens=False)]
    assert count.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]
    assert counting.texts < len(words) / 100
    same, sizes = P._joined_ids(made, None, words)  # a model that does not mark where words end
    assert same.tolist() == ids.tolist() and sizes.tolist() == count.tolist()
