import hashlib
import random
import re

import pytest

from fieldmark.llm import substring_dedup as S

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, n):
    words = [(i, WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - n + 1):
            if i is not None:
                run = tuple(w[k : k + n])
                first[run] = min(first.get(run, i), i)
    out = []
    for i, w in words:
        gone = {k + d for k in range(len(w) - n + 1) if i is not None and first[tuple(w[k : k + n])] < i for d in range(n)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def run(spark, rows, n):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, runs int").repartition(3)
    got = S.remove_repeats(docs, words=n, with_text=True).collect()
    texts = dict(zip([r.kept_sha256 for r in got], [r.kept_text for r in got], strict=True))
    for r in got:
        if not r.n_removed:
            assert r.kept_text == r.row.text
    return sorted(((r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str), texts


@pytest.mark.parametrize(("seed", "n"), [(1, 10), (2, 4), (3, 50)])
def test_against_plain_python(spark, seed, n):
    rng = random.Random(seed)
    passages = [[f"p{k}x{i}" for i in range(rng.randint(n - 1, 3 * n))] for k in range(4)] + [["é"] * (2 * n), ["a", "b"] * n]
    rows = []
    for i in rng.sample(range(1000), 60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(0, n))] + rng.choice(passages)[rng.randint(0, 3) :]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (5, rows[0][1]), (2003, rows[0][1])]
    got, _ = run(spark, rows, n)
    want = plain(rows, n)
    assert got == sorted([w[:4] for w in want], key=str)
    assert sum(w[2] for w in want) > 0


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(12))
    rows = [(3, text), (3, text), (None, text), (None, text), (8, "x " + text + " y")]
    got, texts = run(spark, rows, 10)
    assert got == sorted([w[:4] for w in plain(rows, 10)], key=str)
    assert texts[next(g[3] for g in got if g[0] == 8)] == "x y"
    assert run(spark, rows[:0], 10)[0] == []
