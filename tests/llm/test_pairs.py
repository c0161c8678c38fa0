"""Components, n-gram join, vectors: against comparing every pair."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fieldmark.llm import near_vectors as V
from fieldmark.llm import ngram_join as J
from fieldmark.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def merged(nodes, links):
    name = {n: n for n in nodes}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        name[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def joined(rows, n, percent):
    sets = {}
    for i, text in rows:
        words = WORDS.findall((text or "").translate(LOWER))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    name = merged(ids, links)
    return {i: (len(sets[i]), name[i]) for i in ids}


def test_components_of_a_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (7, 7), (None, 3), (300, 301), (301, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == merged(range(41), links[:40]) | {i: 100 for i in range(100, 130)} | {300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def corpus(seed):
    rng = random.Random(seed)
    rows, vocabulary = [], [f"W{i}" for i in range(60)]
    for family in range(6):
        start = [rng.choice(vocabulary) for _ in range(rng.choice([25, 60, 150]))]
        for _ in range(8):
            text = list(start)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text) if rng.random() < 0.7 else "\n".join(text).lower())
    return rows + ["", None, "a", "a b", "A  b", "a b c", "the same " * 400, "the same " * 300]


@pytest.mark.parametrize(("words", "percent", "block"), [(3, 90, 2048), (5, 80, 2)])
def test_join_against_all_pairs(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rows = list(enumerate(corpus(words), start=10))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs, words=words, percent=percent).collect()}
    assert got == joined(rows, words, percent)


def test_overlaps_drop_pairs_under_the_bound_of_their_sizes_and_no_others(monkeypatch):
    """Sets of numbers, of which the first come first; every pair of them, one or all columns in a block."""
    rng, percent = random.Random(5), 80
    sets = [sorted(rng.sample(range(60), 40)) for _ in range(12)]
    sets += [sorted(set(s[: -rng.randint(1, 6)]) | {60 + rng.randrange(9)}) for s in sets]
    keep = [len(s) - -(-percent * len(s) // 100) + 1 for s in sets]
    cells = sorted((t, i, at) for i, s in enumerate(sets) for at, t in enumerate(s[: keep[i]]))
    schema = {
        "token": [t for t, _, _ in cells], "i": [0] * len(cells), "j": [0] * len(cells), "k": [0] * len(cells),
        "id": [i for _, i, _ in cells], "n": [len(sets[i]) for _, i, _ in cells], "name": [i - 9 for _, i, _ in cells],
        "at": [at for _, _, at in cells], "component": [i for _, i, _ in cells], "parity": [bytes(64)] * len(cells),
    }
    whole = pa.RecordBatch.from_pydict(schema)
    tokens = np.array(schema["token"])
    single = [whole.filter(pa.array(tokens == t)) for t in np.unique(tokens)]
    for batches in ([whole], single):
        total = {}
        for out in (r for b in batches for o in J._overlaps(iter([b]), percent) for r in o.to_pylist()):
            shared, last, need = total.get((out["a"], out["b"]), (0, (-1, 0), 0))
            total[out["a"], out["b"]] = shared + out["shared"], max(last, (out["at"], out["room"])), out["need"]
        open_pairs = {p for p, (shared, (_, room), need) in total.items() if shared + room >= need}
        links = {
            (a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
            if 100 * len({*sets[a]} & {*sets[b]}) >= percent * len({*sets[a]} | {*sets[b]})
        }
        assert links and links <= open_pairs and len(open_pairs) < len(total)


def test_join_of_long_texts(spark):
    """A text of over 1 MB, its near copy, and others that share a rare shingle by chance."""
    rng = random.Random(8)
    long = [f"w{rng.randrange(10**6)}" for _ in range(160_000)]
    near = [w if k % 100 else "changed" for k, w in enumerate(long)]
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(near[:1000]))]
    rows += [(10 + i, " ".join([f"v{rng.randrange(10**6)}" for _ in range(1500)] + long[:9])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(rows[0][1]) > 1 << 20
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(docs).collect()}
    assert got == joined(rows, 3, 90)


def test_join_edges(spark):
    text, other = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, text, 1), (5, other, 1), (2, text, 1), (9, other, 1), (None, text, 1), (7, None, 1), (7, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = sorted(tuple(r) for r in J.jaccard_components(docs).collect() if r.doc_id is not None)
    assert got == [(2, 28, 2), (5, 28, 2), (5, 28, 2), (7, 0, 7), (7, 0, 7), (9, 28, 2)]
    assert [tuple(r) for r in J.jaccard_components(docs).where("doc_id is null").collect()] == [(None, 28, None)]
    assert J.jaccard_components(docs.limit(0)).count() == 0


def linked(rows, least):
    fine = {}
    for i, vector, label in rows:
        if vector and label is not None and None not in vector and np.isfinite(vector).all() and any(vector):
            fine[i] = np.array(vector, np.float32).astype(float), label
    links = [
        (a, b) for a in fine for b in fine
        if a < b and fine[a][1] == fine[b][1] and len(fine[a][0]) == len(fine[b][0])
        and fine[a][0] @ fine[b][0] / np.linalg.norm(fine[a][0]) / np.linalg.norm(fine[b][0]) >= least
    ]
    name = merged([i for i, _, _ in rows], links)
    count = {i: sum(i in pair for pair in links) for i in name}
    return {i: (count[i], name[i], name[i] == i) for i in name}


@pytest.mark.parametrize("cell", [8192, 7])
def test_vectors_against_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(V, "CELL", cell)
    monkeypatch.setattr(V, "BLOCK", 16 if cell == 7 else V.BLOCK)
    rng = np.random.default_rng(cell)
    rows = []
    for i in range(150):
        vector = rng.normal(size=8) if i % 3 == 0 else np.array(rows[rng.integers(0, i)][1]) * rng.uniform(0.5, 2) + rng.normal(size=8) * 0.03
        rows.append((1000 - i, [float(np.float32(x)) for x in vector], int(rng.integers(0, 2))))
    rows += [(1, rows[0][1], rows[0][2]), (2, rows[0][1], rows[0][2]), (3, None, 0), (4, [], 0), (5, [0.0] * 8, 0), (6, [float("nan")] * 8, 0)]
    rows += [(7, [None] * 8, 0), (8, rows[0][1], None), (9, rows[0][1][:4], rows[0][2]), (10, [float("inf")] * 8, 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in V.near_vectors(vectors, 0.98).collect()}
    assert got == linked(rows, 0.98)


def test_vector_edges(spark):
    rows = [(None, [1.0, 0.0], 1, 5), (4, [1.0, 0.0], 1, 5), (4, [1.0, 0.0], 1, 6)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep int")
    got = sorted((tuple(r) for r in V.near_vectors(vectors).collect()), key=str)
    assert got == [(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, True)]
    assert V.near_vectors(vectors.limit(0)).count() == 0


def test_labels_of_the_given_table_have_several_cells(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.where("label is not null").selectExpr("cast(label as bigint) as label", "embedding as vec", "size(embedding) as dim", "vec_id as rep", "1L as n", "xxhash64(label, embedding) as hash")
    pivots = V._pivots(rows)
    cells = rows.select("label", "dim", "rep", "hash", "n", "vec").mapInArrow(V._cell_rows(pivots, 0.98), V._CELLS.format(kind="float"))
    lived = {r.label: r.n for r in cells.where("lives").groupBy("label").agg({"pivot": "approx_count_distinct"}).toDF("label", "n").collect()}
    assert lived and all(n > 1 for n in lived.values())
    assert cells.where("lives").count() == rows.count()  # each vector lives in one cell


def test_more_labels_than_pivots_and_double_precision(spark, monkeypatch):
    monkeypatch.setattr(V, "PIVOTS", 8)
    rng = random.Random(3)
    data = []
    for label in range(6):
        base = [rng.gauss(0, 1) for _ in range(5)]
        for k in range(6):
            data.append((len(data), [x + (1e-9 * k if k < 3 else rng.gauss(0, 1)) for x in base], label))
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in V.near_vectors(table, 0.98).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in data}
    want = {i: sum(1 for j, _, m in data if j != i and m == label and float(unit[i] @ unit[j]) >= 0.98) for i, _, label in data}
    assert got == want
