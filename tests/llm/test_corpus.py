"""LM scores and the pipeline."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

import corpus_pipeline
from fieldmark.llm import pseudo_likelihood as L
from fieldmark.llm.words import words_of
from fieldmark.session import settle

from .test_pairs import joined
from .test_substring_dedup import plain


def language(rng, n):
    """Words that follow each other by a rule, so that neighbours tell."""
    word, out = rng.randrange(30), []
    for _ in range(n):
        out.append(f"w{word}")
        word = (word * 7 + rng.choice([1, 2])) % 30
    return out


def plain_scores(texts):
    """Scores by loops over words: classes and the network are the module's, contexts and counts are not."""
    lists = [(t or "").lower().split() for t in texts]
    words = [w for t in lists for w in t]
    bucket = dict(zip(words, L._buckets(words_of(pa.array([" ".join(words)]))), strict=True))
    classes = L.bucket_classes(np.bincount([bucket[w] for w in words], minlength=1 << L.BITS))
    of = {w: int(classes[bucket[w]]) for w in words}

    def context(t, k):
        out = 0
        for o, size in zip((-2, -1, 1, 2), L.SIDES, strict=True):
            there = 0 <= k + o < len(t)
            c = of[t[k + o]] if there else None
            out = out * size + (size - 1 if c is None else c if abs(o) == 1 else c * L.GROUPS // L.CLASSES)
        return out

    examples, mass, alone, pairs = np.zeros((L.CONTEXTS, L.CLASSES)), Counter(), Counter(words), Counter()
    for t in lists:
        for k, w in enumerate(t):
            examples[context(t, k), of[w]] += 1
            mass[of[w]] += 1
            pairs.update((w, o, t[k + o]) for o in (-2, -1, 1, 2) if 0 <= k + o < len(t))
    network = L.WindowNetwork()
    losses = network.train(examples)
    table, every = network.forward()[1], []
    for strength in L.STRENGTHS:
        each = []
        for t in lists:
            total = 0.0
            for k, w in enumerate(t):
                p = np.exp(table[context(t, k), of[w]]) * alone[w] / mass[of[w]]
                for o in (-2, 2, -1, 1):
                    if 0 <= k + o < len(t):
                        p = (pairs[w, o, t[k + o]] - 1 + strength * p) / (alone[t[k + o]] - 1 + strength)
                total += np.log(p)
            each.append(total)
        every.append(each)
    return max(every, key=sum), losses


def test_scores_against_a_plain_sum_and_shuffled_texts(spark):
    rng = random.Random(4)
    texts = [language(rng, rng.randint(30, 80)) for _ in range(150)]
    mixed = [rng.sample(t, len(t)) for t in texts[:30]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000 + i, " ".join(t)) for i, t in enumerate(mixed)] + [(2000, None), (2001, " ")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, chunk int, slot string").repartition(3)
    got = {r.doc_id: r for r in L.pseudo_likelihood(docs).collect()}
    assert (got[2000].n_tokens, got[2000].log_likelihood, got[2000].mean_log_likelihood) == (0, 0.0, None) == tuple(got[2001])[1:]
    # held in order, the same words are far likelier than shuffled
    assert sum(got[i].log_likelihood > got[1000 + i].log_likelihood for i in range(30)) >= 29
    want, losses = plain_scores([t for _, t in rows])
    assert losses[-1] < 0.6 * losses[0]
    assert all(abs(score - got[i].log_likelihood) < 1e-2 for (i, _), score in zip(rows, want, strict=True))


def test_words_are_told_by_their_neighbours(spark):
    """A vocabulary far larger than the classes, a word of all chunks, a text of several chunks, a tree of many levels."""
    rng = random.Random(8)
    texts = []
    for _ in range(400):
        heads = [rng.randrange(600) for _ in range(15)]
        texts.append([w for h in heads for w in (f"A{h}", f"b{h * 7 % 600}", f"c{h * 11 % 600}")] + ["the"])
    wrong = [[w if w[0] != "b" else f"b{rng.randrange(600)}" for w in t] for t in texts[:40]]
    long = [w for t in texts[100:200] for w in t]
    odd = [(None, "a1"), (None, "alone beside"), (7, "a7 b49"), (7, "a7 b49"), (3000, " ".join(long))]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(1000 + i, " ".join(t)) for i, t in enumerate(wrong)] + odd
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    result = L.pseudo_likelihood(docs, chunk=6000, fan_bits=2).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in result) == sorted((i or -1, len(t.split())) for i, t in rows)
    assert sorted(r.log_likelihood for r in result if r.doc_id == 7)[1:] == [max(r.log_likelihood for r in result if r.doc_id == 7)] * 2
    got = {r.doc_id: r.log_likelihood for r in result if r.doc_id not in (None, 7)}
    assert all(got[i] > got[1000 + i] + 10 for i in range(40) if i != 7)
    want = plain_scores([t for _, t in rows])[0]
    assert all(abs(score - got[i]) < 2e-2 for (i, _), score in zip(rows, want, strict=True) if i in got)
    again = L.pseudo_likelihood(docs).collect()  # one level
    key = lambda r: (r.doc_id or -1, r.n_tokens, round(r.log_likelihood, 2))
    assert [key(r)[:2] for r in sorted(again, key=key)] == [key(r)[:2] for r in sorted(result, key=key)]
    assert all(abs(a.log_likelihood - b.log_likelihood) < 1e-3 for a, b in zip(sorted(again, key=key), sorted(result, key=key), strict=True))


def test_scores_of_nothing(spark):
    assert L.pseudo_likelihood(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pipeline_stage_by_stage(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) in (4, 5)
    stages = dict(corpus_pipeline.STAGES)

    judged = settle(stages["quality_rules"](spark, docs, folder))
    assert judged.columns == columns and 0 < judged.count() <= docs.count()

    single = settle(stages["ngram_jaccard_join"](spark, judged, folder))
    texts = {r.doc_id: r.text for r in judged.collect()}
    want = {i for i, (_, c) in joined(list(texts.items()), 5, 80).items() if i == c}
    assert single.columns == columns and {r.doc_id for r in single.collect()} == want

    passed = settle(stages["substring_dedup"](spark, single, folder))
    kept = {i: (gone, text) for i, _, gone, _, text in plain([(i, texts[i]) for i in want], 50)}
    for r in passed.collect():
        gone, text = kept[r.doc_id]
        assert r.text == (text if gone else texts[r.doc_id]) and (not gone or r.n_chars == len(text))
    assert passed.columns == columns and passed.count() == len(want)

    packed = stages["packing"](spark, passed, folder).collect()
    assert {r.doc_id for r in packed} == want
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, packed))


def test_pipeline_with_odd_rows(spark):
    text = " ".join(f"a{i % 50}b{i % 7}" for i in range(60))
    rows = [(1, text, "en", "s", 9), (1, text, "en", "s", 9), (2, text, "de", "s", 9), (None, text, "en", None, None), (3, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    stages = dict(corpus_pipeline.STAGES)
    single = stages["ngram_jaccard_join"](spark, docs, "").collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in single if r.doc_id is not None) == [(False, 1), (False, 3)]
    assert len(single) == 3
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0, name


def test_scores_of_a_chunk_take_little_memory(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(40000)}" for _ in range(rng.choice([0, 1, 2, 30, 3000]))) for _ in range(250)]
    texts += [None, "", "one"]
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["id", "text"])
    keys, _ = L._keys(words_of(docs.column("text")), 50)
    distinct, told = L._distinct(keys.copy())
    assert told.sum() == len(keys) and distinct.tolist() == sorted(set(keys.tolist()))
    chunk = pa.table({"chunk": [1], "docs": pa.array([L._stored([docs])], pa.binary())})
    answers = pa.table({"place": pa.array([0], pa.int32()), "counts": pa.array([L._packed(told, np.int64)], pa.binary())})
    classes = np.arange(1 << L.BITS) % L.CLASSES
    table = np.random.default_rng(0).normal(-3, 1, (L.CONTEXTS, L.CLASSES)).astype(np.float32)
    score = L._scored(classes, table, np.full(L.CLASSES, 1e6), 50)
    results = []
    for size in (1 << 40, 1 << 14, 50):
        monkeypatch.setattr(L, "SLICE", size)
        tracemalloc.start()
        results.append(score(chunk, answers))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        if size == 1 << 14:
            assert peak < 40 * len(keys)
    assert results[0].equals(results[1]) and results[0].equals(results[2])
    assert results[0]["n_tokens"].to_pylist() == [len((t or "").split()) for t in texts]
