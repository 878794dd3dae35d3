"""Collocations, decontamination and hard negatives against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from flowrisk.llm import collocations, decontaminate, hard_negatives
from flowrisk.llm.collocations import DoubleArray
from flowrisk.llm.fm_index import FMIndex, suffix_array
from tests.llm.conftest import DOCS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Collocations

def plain_collocations(rows, support, top):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        found = []
        for p, a in candidates.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(100 * b >= 80 * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, b in candidates.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def listed(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def phrase_docs():
    rng = random.Random(2)
    words = ["Der", "hund", "BELLT", "ä", "日本", "x\x1cy", "a b", "it's", "of", "the"]
    rows = []
    for i in range(120):
        tokens = []
        for _ in range(rng.randrange(40)):
            tokens.append(rng.choice(["of the", "der hund bellt", "of the hund ä"]) if rng.random() < 0.3 else rng.choice(words))
            tokens.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " \r\n"]) if rng.random() < 0.3 else " ")
        rows.append((i, "".join(tokens), rng.choice(["de", "en", None, "und"]), "s", 1))
    return rows + rows[:30] + [(None, None, None, None, None), (7, "", "fr", None, 0), (8, ".,;:!?\n", "xx", None, 0)]


@pytest.mark.parametrize("gate,trie,top", [(4_000_000, 1_000_000, 2000), (5, 1_000_000, 7), (0, 40, 2000)])
def test_collocations_equal_a_plain_count(spark, phrase_docs, gate, trie, top):
    docs = spark.createDataFrame(phrase_docs, DOCS).repartition(5)
    for name in ("phrase", "a", "code", "words", "parts"):
        docs = docs.selectExpr("*", f"'clash' as {name}")
    made = collocations.collocations(docs, support=6, top=top, gate_rows=gate, trie_rows=trie)
    assert listed(made) == plain_collocations(phrase_docs, 6, top)


def test_collocations_of_long_lines_and_nothing(spark, no_docs, monkeypatch):
    monkeypatch.setattr(collocations, "PIECE", 50)
    rng = random.Random(3)
    rows = [(1, " ".join(rng.choice("abc") for _ in range(5000)), "en", "s", 1)]
    made = collocations.collocations(spark.createDataFrame(rows, DOCS), support=300)
    assert listed(made) == plain_collocations(rows, 300, 2000)
    assert collocations.collocations(no_docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, "few words", "en", "s", 1)], DOCS)).count() == 0


def test_collocations_of_odd_rows(odd_docs):
    rows = [tuple(r)[:5] for r in odd_docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert listed(collocations.collocations(odd_docs, support=4)) == plain_collocations(rows, 4, 2000)


@pytest.mark.parametrize("gate", [4_000_000, 100, 0])
def test_collocations_list_a_phrase_about_once(spark, monkeypatch, gate):
    # The same 144 pairs and longer phrases in each of twelve files.
    rows = [(i, " ".join(f"w{j}" for j in range(50)), "en", "s", 1) for i in range(120)]
    frame, made = type(spark.range(0)), []
    plain = frame.distinct
    monkeypatch.setattr(frame, "distinct", lambda self: (made.append(self.count() if "words" in self.columns else 0), plain(self))[1])
    docs = spark.createDataFrame(rows, DOCS).repartition(12, "doc_id")
    assert listed(collocations.collocations(docs, gate_rows=gate)) == plain_collocations(rows, 30, 2000)
    assert 49 + 48 + 47 <= sum(made) <= 2 * (49 + 48 + 47)


@pytest.mark.parametrize("gate,trie", [(4_000_000, 1_000_000), (4_000_000, 40), (5, 1_000_000)])
def test_collocations_of_phrases_that_share_hashes(spark, phrase_docs, monkeypatch, gate, trie):
    monkeypatch.setattr(collocations, "BITS", 5)
    docs = spark.createDataFrame(phrase_docs, DOCS).repartition(5)
    made = collocations.collocations(docs, support=6, gate_rows=gate, trie_rows=trie)
    assert listed(made) == plain_collocations(phrase_docs, 6, 2000)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=4).map(tuple), max_size=40, unique=True), st.lists(st.integers(0, 13), max_size=60))
def test_double_array_counts(phrases, line):
    trie = DoubleArray(pa.array([list(p) for p in phrases], pa.list_(pa.int64())))
    counts = np.zeros(len(trie.check), np.int64)
    for states in trie.levels(np.array(line, np.int64)):
        counts += np.bincount(states, minlength=len(counts))
    assert len(set(trie.state.tolist())) == len(phrases)
    for p, s in zip(phrases, trie.state):
        assert counts[s] == sum(tuple(line[i:i + len(p)]) == p for i in range(len(line)))


def test_double_array_of_crowded_states():
    rng = random.Random(1)
    phrases = list({(rng.choice([5, 6, 10 ** 15]), rng.randrange(3000), rng.randrange(3)) for _ in range(9000)})
    trie = DoubleArray(pa.array([list(p) for p in phrases], pa.list_(pa.int64())))
    for p in rng.sample(phrases, 300):
        *_, last = trie.levels(np.array(p))
        assert trie.state[phrases.index(p)] in last


# Decontamination

def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        for i in range(max(len(words) - 9, min(len(words), 1))):
            windows[tuple(words[i:i + 10])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for w, who in windows.items():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found |= who
        spans = [[i, i + 1] for i in sorted(hit)]
        merged = []
        for s, e in spans:
            if merged and merged[-1][1] == s:
                merged[-1][1] = e
            else:
                merged.append([s, e])
        out.append((doc_id, len(words), tuple(map(tuple, merged)), tuple(sorted(found))))
    return sorted(out, key=repr)


def found_rows(df):
    return sorted(((r["doc_id"], r["n_words"], tuple((s["start"], s["end"]) for s in r["spans"]), tuple(r["items"]))
                   for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(8)
    words = ["Alpha", "beta", "γ", "d4", "日本", "o'k", "e-f", "g_h", "\x00i", "café"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(14)]
    items += [(3, text(12)), (3, items[3][1]), (None, text(11)), (None, text(2)), (77, None), (78, ""), (79, " -- ")]
    docs = [(i, text(rng.randrange(60))) for i in range(60)]
    for i in range(25):
        docs.append((100 + i, text(5) + ", " + (rng.choice(items)[1] or "").upper() + "!"))
    docs += [(None, None), (None, items[0][1]), (5, ""), (2, docs[2][1]), (2 ** 60 + 1, " ".join(t for _, t in items if t) * 3)]
    return docs, items


@pytest.mark.parametrize("slice_chars,shard_chars", [(20_000_000, 4_000_000), (300, 4_000_000), (20_000_000, 100)])
def test_contamination_equals_a_plain_search(spark, leaks, monkeypatch, slice_chars, shard_chars):
    monkeypatch.setattr(decontaminate, "SHARD_CHARS", shard_chars)
    docs, items = leaks
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'clash' as items", "'clash' as n_words").repartition(3)
    made = decontaminate.contamination(rows, spark.createDataFrame(items, "item_id long, text string"), slice_chars=slice_chars)
    assert found_rows(made) == plain_contamination(docs, items)
    assert any(spans for _, _, spans, _ in found_rows(made))


def test_contamination_of_nothing(spark, no_docs, odd_docs):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(no_docs, items).count() == 0
    clean = decontaminate.contamination(odd_docs, none)
    assert clean.count() == odd_docs.count() and clean.filter("size(spans) > 0").count() == 0


def test_removed_spans_leave_the_rest_of_the_text(spark):
    leak = "a b c d e f g h i j k"
    docs = spark.createDataFrame([(1, f"Är: {leak.upper()} -- end"), (2, "clean, text"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    made = {r["doc_id"]: r["kept_text"] for r in decontaminate.contamination(docs, items, with_text=True).collect()}
    assert made == {1: "Är:  -- end", 2: "clean, text", 3: None}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=50), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=5), min_size=1, max_size=6), st.integers(1, 9))
def test_fm_index_finds_all_places(text, patterns, sample):
    s = np.array(text, np.int64)
    whole = [*text, 0]
    assert suffix_array(np.array(whole)).tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    index = FMIndex(s, 5, sample)
    table = np.zeros((len(patterns), 5), np.int64)
    for k, p in enumerate(patterns):
        table[k, :len(p)] = p
    low, high = index.search(table, np.array([len(p) for p in patterns]))
    for k, p in enumerate(patterns):
        places = sorted(index.locate(np.arange(low[k], high[k])).tolist())
        assert places == [i for i in range(len(text) - len(p) + 1) if text[i:i + len(p)] == p]


def test_items_found_have_the_digest_of_the_contract(spark, folder):
    from flowrisk.llm.queries import op12_decontamination
    made = op12_decontamination(spark, folder)
    empty = hashlib.sha256(b"").hexdigest()
    assert made.filter("n_items = 0").select("items_sha256").distinct().collect()[0][0] == empty
    assert made.filter("contaminated <> (n_hit > 0) or n_hit > n_words").count() == 0


# Hard negatives

def plain_negatives(rows):
    use = {}
    for vec_id, x, label in rows:
        if vec_id is None or label is None or x is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        use.setdefault(vec_id, set()).add((label, tuple(int(np.floor(256 * float(np.float32(v)))) for v in x)))

    def dot(a, b):
        return sum(p * q for p, q in zip(a, b))

    out = []
    for anchor in sorted(i for i in use if i % 100 == 0):
        label, q = min(use[anchor])
        best = lambda fits: sorted((-s, i) for i, s in (
            (i, max((dot(q, x) for kind, x in use[i] if fits(kind, dot(q, x))), default=None)) for i in use if i != anchor) if s is not None)[:5]
        for s, positive in best(lambda kind, _: kind == label):
            s = -s
            for rank, (n, negative) in enumerate(best(lambda kind, v: kind != label and 80 * s <= 100 * v <= 100 * s), 1):
                out.append((anchor, positive, rank, negative, s, -n))
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int"


def mined(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def vectors(n, dims, seed, step=20):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    rows = []
    for i in range(n):
        kind = int(rng.integers(4))
        x = centres[kind] + 0.4 * rng.normal(size=dims)
        x = x / np.linalg.norm(x)
        rows.append((i * step, [float(np.float32(v)) for v in x], kind if rng.random() < 0.8 else int(rng.integers(10))))
    return rows


@pytest.mark.parametrize("n,dims,block", [(300, 24, 65_536), (120, 7, 5), (40, 1, 65_536)])
def test_hard_negatives_equal_brute_force(spark, n, dims, block):
    rows = vectors(n, dims, n)
    rows += [(*r[:1], rows[(k + 9) % n][1], r[2]) for k, r in enumerate(rows[:20])] + rows[:9]  # ties, repeated ids, repeated rows
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 as window", "2 as score", "3 as rank").repartition(4)
    assert mined(hard_negatives.hard_negatives(df, block=block)) == plain_negatives(rows)


def test_hard_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 5, 3) + [
        (None, [1.0] * 5, 1), (100_000, None, 1), (100_100, [1.0] * 5, None), (100_200, [nan] * 5, 1), (100_300, [inf, 0.0, 0.0, 0.0, 0.0], 1),
        (100_400, [None, 1.0, 0.0, 0.0, 0.0], 1), (100_500, [], 1), (100_600, [0.5, 0.5], 1), (100_700, [0.0] * 5, 2), (100_701, [-1.0] * 9, 2)]
    assert mined(hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS))) == plain_negatives(rows)
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1)], VECTORS)).count() == 0


def test_index_leaves_out_dimensions_and_loses_no_pair():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(500, 32)) * 60)
    shard, q = hard_negatives.Shard(x), x[:20]
    t = np.full(20, 0.6 * np.linalg.norm(q, axis=1).min() ** 2)
    i, j, score = shard.above(q, t)
    exact = q @ x.T
    assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(exact >= t[:, None])))
    assert (exact[i, j] == score).all()
    assert (shard.before[:, 8] * np.linalg.norm(q[:, shard.order[:8]], axis=1).max() < t[0]).any()


def test_hot_label_is_spread(spark):
    """A label of most rows: each task sends a bounded number of rows a window."""
    rows = [(i, x, 1 if i % 10 else k) for i, (_, x, k) in enumerate(vectors(400, 8, 9))]
    assert mined(hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(8))) == plain_negatives(rows)
