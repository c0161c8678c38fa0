import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldmark.llm import words as W

PATTERN = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t\x0b\x1c ", max_size=12)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    found = W.words_of(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert found.text(i).decode() == " ".join(PATTERN.findall(text or ""))


def test_equal_words_hash_alike_wherever_they_stand():
    found = W.words_of(pa.array(["ab Ab x", "x ab"]))
    plain, low = found.hashes(), found.hashes(lower=True)
    assert plain[0] == plain[4] and plain[2] == plain[3] and plain[0] != plain[1]
    assert low[0] == low[1] == low[4]


def test_a_word_longer_than_a_slice(monkeypatch):
    texts = pa.array(["a" * 50 + " bcd", "bcd " + "a" * 50, "a" * 49 + "b"])
    monkeypatch.setattr(W, "SLICE", 16)
    hashes = W.words_of(texts).hashes()
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] and hashes[0] != hashes[4]


def test_windows_stay_within_texts():
    found = W.words_of(pa.array(["a b c", "", "a b", "x a b c"]))
    runs, bounds = W.windows(found.hashes(), found.first, 2)
    assert bounds.tolist() == [0, 2, 2, 3, 6]
    assert runs[0] == runs[2] == runs[4] and runs[1] == runs[5] and len(set(runs.tolist())) == 3


def test_groups_are_never_cut():
    batches = [pa.RecordBatch.from_pydict({"k": k}) for k in ([1, 1], [1, 2], [2, 2], [3])]
    got = [b.column("k").to_pylist() for b in W.groups(iter(batches), ["k"])]
    assert sum(got, []) == [1, 1, 1, 2, 2, 2, 3]
    assert all(not set(a) & set(b) for a, b in zip(got, got[1:]))


def test_parts_hold_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["aaaa", None, "b" * 40, "", "c"]})
    assert [p.num_rows for p in W.parts(batch, "text", 8)] == [2, 2, 1] or sum(p.num_rows for p in W.parts(batch, "text", 8)) == 5
    assert np.concatenate([p.column("text").to_pylist() for p in W.parts(batch, "text", 8)]).tolist() == batch.column("text").to_pylist()


def test_a_group_of_over_two_gigabytes_keeps_its_rows():
    one = pa.RecordBatch.from_arrays([pa.array([7] * 4), pa.array([bytes(1 << 22)] * 4, pa.binary())], ["k", "packed"])
    sizes = [(b.num_rows, set(b.column("k").to_pylist())) for b in W.groups(iter([one] * 130), ["k"])]
    assert sizes == [(520, {7})]
