"""SentencePiece by agenda against its library; fill-in-middle against a plain version."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldmark.llm import fill_in_middle as M
from fieldmark.llm import piece_agenda as A
from fieldmark.llm.queries import tokenizer_path

pytest.importorskip("sentencepiece")
MODEL = tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  ", "\n", "a", "hello world", "don't stop", "日本語 é ñ", "a" * 300, " " * 100, "▁a ▁▁ b", "<s> </s> <0x41> <unk>", "x\x00y", "\U0001f600 ok 𝔘",
    "tab\tcr\r\n", "ab" * 5000, "1234 56", " lead", "trail  ", "é", "hello world",
]


def ids_of(texts):
    ids, bounds = A.encoded(MODEL, texts)
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]


def library(texts):
    return A.vocabulary(MODEL).library.encode([t or "" for t in texts], add_eos=True)


def test_ids_equal_the_library():
    rng = random.Random(5)
    mixed = ["".join(rng.choice("ab'st e\n \t.,!1é日< ▁theing") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    wide = ["".join(chr(rng.choice([rng.randint(1, 0x2FFF), rng.randint(0x4E00, 0x9FFF), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(20)) for _ in range(200)]
    texts = TEXTS + mixed + wide
    assert ids_of(texts) == library(texts)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_text_equals_the_library_and_comes_back(text):
    ids = ids_of([text, "x", text])
    assert ids[0] == ids[2] == library([text])[0]
    assert A.vocabulary(MODEL).text(np.array(ids[0])) == text.replace(A.BLANK, " ")


def test_any_ids_decode_as_in_the_library():
    rng, words = random.Random(7), A.vocabulary(MODEL)
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(3, 258), rng.randint(259, 31999), 29871, 259]) for _ in range(rng.randint(0, 7))]
        assert words.text(np.array(ids, np.int64)) == words.library.decode(ids)


def test_heap_and_rounds_agree():
    words, rng = A.vocabulary(MODEL), random.Random(2)
    for _ in range(300):
        code = np.array([ord(c) for c in "".join(rng.choice(" theingabs") for _ in range(rng.randint(1, 40)))])
        symbol = words.symbols(code)
        assert words.worked_off(symbol.copy(), np.array([0]))[0].tolist() == words.worked_off_alone(symbol.tolist())


def test_a_difference_from_the_library_ends_the_job():
    words = A.vocabulary(MODEL)
    with pytest.raises(RuntimeError):
        words.check(["the"], np.array([5]), np.array([1]))


def test_tables_of_pieces(spark):
    long = " ".join(f"word{i}" for i in range(200_000))
    texts = [*TEXTS, long]
    docs = spark.createDataFrame([(i if i else None, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids int, id string").repartition(3)
    back = {r.doc_id: r.text for r in A.decode(A.encode(docs, MODEL), MODEL).collect()}
    assert back == {i if i else None: (t or "").replace(A.BLANK, " ") for i, t in enumerate(texts)}
    assert all(r.same for r in A.compared(docs, MODEL).collect())
    digests = {r.doc_id: r for r in A.coded_digests(docs, MODEL).collect()}
    for i, (ids, text) in enumerate(zip(library(texts), texts, strict=True)):
        r = digests[i if i else None]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").replace(A.BLANK, " ").encode()).hexdigest()
    assert A.encode(docs.limit(0), MODEL).count() == A.coded_digests(docs.limit(0), MODEL).count() == 0


def plain_middle(doc_id, text, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("percent", "spm"), [(100, 50), (40, 0), (0, 50)])
def test_middle_equals_a_plain_version(spark, percent, spm):
    rng = random.Random(1)
    texts = [None, "", "\n", "a", "a\nb", "a\n\n\nb\n", "x<P>y", "a<M>", "$1\\2 <", "\\Q\\E$\n", "日本\n语\U0001f600\n", "l\r\nm n\x0b\n", "<P", "P>\nS>", "a\nb"]
    texts += ["".join(rng.choice("ab\n<PSM>\\$1é") for _ in range(rng.randint(0, 50))) for _ in range(300)]
    texts += ["x\n" * 200_000, "word " * 300_000, "\n" * 100_000 + "z"]
    # names that clash with those the operator makes, a null id, a repeated row
    rows = [(i if i else None, t, "c", 0, "d") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[14]], "doc_id long, text string, form string, n int, `row` string").repartition(4)
    got = M.restored(M.fill_in_middle(docs, percent=percent, spm_percent=spm)).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = texts[r.row.doc_id or 0]
        assert (r.n, r.form, r.prefix, r.middle, r.suffix, r.output) == plain_middle(r.row.doc_id, text, percent, spm)
        assert r.restored == (text or "")


def test_middle_of_an_empty_table_and_other_units(spark):
    docs = spark.createDataFrame([(1, "one two  three")], "doc_id long, text string")
    assert M.restored(M.fill_in_middle(docs.limit(0))).count() == 0
    square = M.Markers("[p]", "[s]", "[m]")
    by_word = M.restored(M.fill_in_middle(docs, unit=r"(?: *+[^ ]++)", markers=square), square).first()
    assert by_word.n == 3 and by_word.restored == "one two  three" and by_word.output.count("[") == 3
    assert M.fill_in_middle(docs).where(F.col("form") == "plain").count() == 0
