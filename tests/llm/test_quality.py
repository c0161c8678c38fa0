import math
import random
import re
import struct
from collections import Counter

import pytest
import xxhash

from fieldmark.llm.quality import BITS, LEAST, ORDERS, SHRINK, quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORDS.findall(text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
TEXTS = [
    None, "", "  \n\t ", "one", "a b " * 30, "x" * 5000, "é#*$%&|<> ü\nab\nab\n \nab", "w0 w1 w2 w3 w4 w5 w6 w7 " * 2 + "x y z",
    " ".join(f"w{i}" for i in range(100)), "same line\nsame line\r\nsame line\n", "a\x0bb\x0cc\rd", "v " * 3000, "a b c",
]


def test_counts_against_plain_python(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    labels = spark.createDataFrame([(8, 1)], "doc_id long, quality int")
    got = {r.row.doc_id: r for r in quality_rules(docs, labels).collect()}
    for i, text in enumerate(TEXTS):
        assert tuple(got[i][c] for c in COLUMNS) == base(text), text
        assert not (got[i].kept and got[i].base_failed)


def grams(text):
    """Buckets of all words and pairs, hashed as Spark hashes a string and two longs."""
    words = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in WORDS.findall(text or "")]
    long = lambda h, seed: xxhash.xxh64(struct.pack("<Q", h), seed=seed).intdigest()
    pairs = [long(b, long(a, 42)) for a, b in zip(words, words[1:])]
    return [h >> (64 - BITS) for h in words + pairs]


def test_score_and_verdict_against_plain_python(spark):
    assert ORDERS == (1, 2)
    rng = random.Random(6)
    good = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(60)) for _ in range(30)]
    odd = [" ".join(rng.choice("vwxyz") * rng.randint(1, 4) + "#" * rng.randint(0, 1) for _ in range(60)) for _ in range(30)]
    mixed = [" ".join(a if rng.random() < k / 20 else b for a, b in zip(good[k].split(), odd[k].split())) for k in range(20)]
    long = " ".join(f"n{rng.randrange(5000)}" for _ in range(200_000))
    texts = [*good, *odd, *mixed, *TEXTS, long]
    marks = {i: 1 for i in range(0, 30, 2)} | {i: 0 for i in range(30, 40)}
    each = [grams(t) for t in texts]
    raw = Counter(g for e in each for g in e)
    trusted = Counter(g for i, e in enumerate(each) for g in e if marks.get(i) == 1)
    share = sum(trusted.values()) / sum(raw.values())
    want = [sum(math.log((trusted[g] + SHRINK) / (raw[g] * share + SHRINK)) for g in e) / len(e) if e else 0.0 for e in each]
    some = sorted(want[:80])
    between = (some[39] + some[40]) / 2  # a threshold that half of the texts reach
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(marks.items()), "doc_id long, quality int")
    for least, judged in ((LEAST, quality_rules(docs, labels)), (between, quality_rules(docs, labels, least=between))):
        for row in judged.collect():
            score = want[row.row.doc_id]
            assert math.isclose(row.score, score, abs_tol=1e-6) and abs(score - least) > 1e-6
            assert row.kept == (not row.base_failed and score >= least)


@pytest.mark.parametrize("orders", [(1,), (1, 2)])
def test_junk_goes_and_clean_stays(spark, orders):
    clean = [" ".join(f"word{(7 * i + 3 * k * k) % 97}" for k in range(60 + i)) for i in range(40)]
    junk = [" ".join(f"@@{(5 * i + k) % 31}@@" for k in range(60)) for i in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(clean + junk)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(i, 0) for i in range(40, 50)], "doc_id long, quality int")
    kept = {r.row.doc_id for r in quality_rules(docs, labels, orders=orders, repeat_percent=100).where("kept").collect()}
    assert kept == set(range(40))


def test_edges(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(None, "a b", 1, "x"), (1, None, 2, "y"), (1, None, 2, "y")], "doc_id long, text string, score int, words string")
    rows = quality_rules(odd, labels).select("row.*", "n_words").collect()
    assert sorted((r.score, r.n_words, r.words) for r in rows) == [(1, 2, "x"), (2, 0, "y"), (2, 0, "y")]
    assert quality_rules(odd.limit(0), labels).count() == 0


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    quality_rules(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).where("kept").explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
