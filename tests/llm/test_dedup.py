"""Substring, near-text and near-vector deduplication against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from flowrisk.llm import graph, near_text, near_vectors, substring
from flowrisk.llm.common import words_of
from tests.llm.conftest import DOCS, words


def plain_repeats(rows, least=50):
    first = {}
    texts = [(i, words_of(t or "")) for i, t in rows]
    for i, ws in texts:
        for k in range(len(ws) - least + 1):
            key = tuple(ws[k:k + least])
            rank = (i is None, i)
            first[key] = min(first.get(key, (True, float("inf"))), (rank[0], -1 if i is None else i))
    out = []
    for i, ws in texts:
        gone = set()
        for k in range(len(ws) - least + 1):
            if first[tuple(ws[k:k + least])] < (i is None, -1 if i is None else i):
                gone.update(range(k, k + least))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), kept))
    return sorted(out, key=str)


def repeats_of(docs):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(docs).collect()), key=str)


def test_repeats_equal_brute_force(spark):
    rng = random.Random(3)
    passages = [words(rng, n) for n in (49, 50, 51, 70, 120, 300)]
    periodic = ["x", "y"] * 60
    rows = []
    for i in range(120):
        ws = []
        for _ in range(rng.randrange(1, 5)):
            ws += words(rng, rng.randrange(0, 60))
            p = rng.choice([*passages, periodic])
            ws += p[rng.randrange(3):len(p) - rng.randrange(3)]
        rows.append((i * 7 % 113, " ".join(ws)))
    docs = spark.createDataFrame([(*r, None, None, 0) for r in rows], DOCS).repartition(5)
    assert repeats_of(docs) == plain_repeats(rows)


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert repeats_of(odd_docs) == plain_repeats(rows)
    assert repeats_of(no_docs) == []


def test_repeat_spans(spark):
    rng = random.Random(8)
    p = words(rng, 60)
    docs = spark.createDataFrame([(1, " ".join(p)), (2, " ".join(["q", *p, "r"]))], "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.stop) for s in r.repeats] for r in substring.remove_repeats(docs).collect()}
    assert spans == {1: [], 2: [(1, 61)]}


def classes_of(rows, least=0.8):
    shingles = [near_text.shingles_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if near_text.similarity(shingles[a], shingles[b], least) >= least:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {rows[k][0]: rows[find(k)][0] for k in range(len(rows))}


def test_near_texts_equal_brute_force(spark):
    rng = random.Random(9)
    rows, common = [], words(rng, 40)
    for base in range(12):
        original = words(rng, rng.randrange(60, 300)) + (common if base % 3 == 0 else [])
        for _ in range(rng.randrange(1, 9)):
            ws = list(original)
            for _ in range(rng.randrange(0, max(1, len(ws) // 50))):
                ws[rng.randrange(len(ws))] = "changed" + str(rng.random())
            rows.append((len(rows), " ".join(ws)))
    docs = spark.createDataFrame([(*r, None, None, 0) for r in rows], DOCS)
    got = {r.doc_id: r.class_id for r in near_text.near_duplicates(docs).collect()}
    assert got == classes_of(rows)


@pytest.mark.parametrize("members, shingles", [(8, 10_000), (512, 500), (512, 500_000)])
def test_blocks_of_a_crowded_bucket_equal_brute_force(spark, monkeypatch, members, shingles):
    monkeypatch.setattr(near_text, "CROWD", 2)
    monkeypatch.setattr(near_text, "BLOCK", members)
    monkeypatch.setattr(near_text, "BLOCK_SHINGLES", shingles)
    rng = random.Random(3)
    original, rows = words(rng, 120), []
    for k in range(90):  # most pairs of copies lie just under the threshold
        ws = list(original)
        for at in rng.sample(range(len(ws)), rng.randrange(1, 5)):
            ws[at] = "changed" + str(rng.random())
        rows.append((k, " ".join(ws)))
    rows += [(100, rows[7][1]), (101, " ".join(reversed(original))), (7, rows[7][1] + " tail")]
    want = classes_of(rows)
    assert len(set(want.values())) > 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_text.near_duplicates(docs).collect()} == want


def test_near_texts_of_odd_rows(odd_docs, no_docs):
    got = near_text.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    classes = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert classes[1] == classes[2] == 1 and classes[3] == 1
    assert classes[4] == classes[5] == classes[6] == 4 and classes[8] == classes[7] == 7
    assert classes[9] == classes[10] == 9 and classes[11] == 11
    assert near_text.near_duplicates(no_docs).count() == 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_alignment_equals_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        assert near_text.aligned(a, b, 60) == lcs(a, b)


def test_pairs_at_the_threshold_are_linked(spark):
    rng, rows, want = random.Random(12), [], {}
    for k in [*range(1, 41)] * 3:  # texts of 5k and 4k shingles, the shorter one the beginning or the end of the longer
        ws = words(rng, 5 * k + 4)
        part = ws[:4 * k + 4] if k % 2 else ws[k:]
        a, b = (near_text.shingles_of(" ".join(x)) for x in (ws, part))
        m = lcs(a, b)
        assert 5 * m == 4 * (len(a) + len(b) - m) and near_text.similarity(a, b, 0.8) == 0.8
        want |= {len(rows): len(rows), len(rows) + 1: len(rows)}
        rows += [(len(rows), " ".join(ws)), (len(rows) + 1, " ".join(part))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_text.near_duplicates(docs).collect()} == want
    for n in range(5, 3001, 5):  # m aligned of n, and one fewer
        a = list(range(n))
        assert near_text.similarity(a, a[:n * 4 // 5], 0.8) == 0.8 > near_text.similarity(a, a[:n * 4 // 5 - 1], 0.8)


def test_short_texts_share_a_pick():
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2 ** 63, (20_000, 5), dtype=np.uint64)
    shared = sum(bool(np.intersect1d(near_text.picks(t), near_text.picks(t[:4])).size) for t in labels)
    assert len(labels) - shared <= 4  # a fifth of the picks agree; 20 of them would miss about 230 pairs


def test_order_matters_to_a_sketch():
    labels = near_text.mix(np.arange(1, 200, dtype=np.uint64))
    a, b = near_text.order_sketch(labels), near_text.order_sketch(labels[::-1].copy())
    assert (a != b).all() and (near_text.order_sketch(labels.copy()) == a).all()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)]
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = start
                todo += near[x]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if k != v}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(40):
        center = rng.standard_normal(24)
        for _ in range(rng.integers(1, 14)):
            rows.append((len(rows), (center + rng.standard_normal(24) * rng.uniform(0, 0.45)).tolist(), 1))
    same = rows[0][1]
    rows += [(1000 + k, same, 1) for k in range(30)] + [(2000, [2 * x for x in same], 1)]
    rows += [(3000, None, 1), (3001, [0.0] * 24, 1), (3002, [float("nan")] + [1.0] * 23, 1), (3003, [None] * 24, 1),
             (3004, [1.0, 2.0], 1), (3005, [], 1), (None, same, 1), (1, rows[1][1], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_near_vectors_equal_brute_force(vectors):
    rows = vectors.collect()
    fine = [k for k, r in enumerate(rows) if r.embedding and len(r.embedding) == 24 and None not in r.embedding
            and np.isfinite(r.embedding).all() and any(r.embedding)]
    x = np.array([rows[k].embedding for k in fine])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want = sorted(near.sum(axis=1).tolist() + [0] * (len(rows) - len(fine)))
    got = near_vectors.near_vectors(vectors, recall=1 - 1e-7, block=8).collect()
    assert sorted(r.n_links for r in got) == want
    links = {rows[k].vec_id: int(n) for k, n in zip(fine, near.sum(axis=1)) if rows[k].vec_id not in (None, 1)}
    assert all(r.n_links == links.get(r.vec_id, 0) for r in got if r.vec_id not in (None, 1))
    component = list(range(len(fine)))
    for _ in range(len(fine)):
        component = [min([component[j] for j in np.flatnonzero(near[i])] + [component[i]]) for i in range(len(fine))]
    smallest = defaultdict(lambda: float("inf"))
    for k, c in zip(fine, component):
        if rows[k].vec_id is not None:
            smallest[c] = min(smallest[c], rows[k].vec_id)
    named = {rows[k].vec_id: smallest[c] for k, c in zip(fine, component)}
    assert all(r.component_id == named.get(r.vec_id, r.vec_id) for r in got)
    assert near_vectors.near_vectors(vectors.limit(0)).count() == 0


def test_code_estimates_are_unbiased():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = x + 0.6 * rng.standard_normal((400, 64)) / 8
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    both = np.concatenate([x, q])
    codes, i = near_vectors.Codes(both), np.arange(400)
    error = codes.estimate(i, i + 400) - (x * q).sum(axis=1)
    assert abs(error.mean()) < 0.02 and (np.abs(error) <= near_vectors.CONFIDENCE * codes.error[:400]).all()


def test_kept_text_digest(spark):
    docs = spark.createDataFrame([(1, " a  b\tc ")], "doc_id long, text string")
    assert hashlib.sha256(substring.remove_repeats(docs).collect()[0].kept_text.encode()).hexdigest() == hashlib.sha256(b"a b c").hexdigest()
