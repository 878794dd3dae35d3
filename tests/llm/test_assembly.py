"""Mixing, packing, WARC and the pipeline."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from flowrisk.llm import mixing, packing, queries, warc
from flowrisk.llm.common import n_words, table
from tests.oracle import connect, difference


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, list(names), share * sum(sizes.values())
    while True:
        w = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / w > limit * sizes[s]]
        if not full:
            return target | {s: left * weight[s] / w for s in free}
        for s in full:
            target[s] = limit * sizes[s]
            left -= target[s]
            free.remove(s)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 500, "c": 3, None: 50, "d": 0}, {"z": 7},
                                   {"A": 10, "a": 20, "é": 30, "B": 1000, "": 5}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], abs=1e-9) for s in want)


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a"] * 6 + ["b", "c", None]), int(rng.lognormvariate(4, 1.2))) for i in range(6000)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mix_sources(sizes, block=150, merge=4).collect()
    again = mixing.mix_sources(sizes.repartition(7), block=150, merge=4).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)
    assert len(got) == len(rows)
    taken, docs, per = defaultdict(int), defaultdict(float), defaultdict(list)
    for r in got:
        taken[r.source] += r.copies * r.size
        docs[r.source] += r.copies
        per[r.source].append(r)
        assert 0 <= r.copies <= 2
    for source, rs in per.items():
        assert abs(taken[source] - rs[0].target) <= max(r.size for r in rs)
        assert abs(docs[source] - len(rs) * rs[0].target / rs[0].source_size) <= 3


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    size, p = rng.integers(0, 400, 500).astype(float), np.full(500, 0.37)
    flown = p.copy()
    mixing._flight(flown, size, rng)
    assert ((flown > 0) & (flown < 1)).sum() <= 2
    assert flown.sum() == pytest.approx(p.sum()) and (flown * size).sum() == pytest.approx((p * size).sum())


def test_mix_of_odd_rows(odd_docs, no_docs):
    got = mixing.mix_sources(mixing.document_sizes(odd_docs)).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.copies <= 2 for r in got)
    assert mixing.mix_sources(mixing.document_sizes(no_docs)).count() == 0


# ---- packing

def check_packed(rows, tokens):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= tokens
    return len(by)


def test_tokens_and_packing_of_documents(spark, folder):
    from tokenizers import Tokenizer

    docs = table(spark, folder, "documents")
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    pieces = packing.tokenized_pieces(docs, queries.tokenizer_path(), tokens=200)
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want += [(r.doc_id, k, at, len(ids[at:at + 200]), zlib.crc32(np.array(ids[at:at + 200], "<u4").tobytes()))
                 for k, at in enumerate(range(0, len(ids), 200))]
    assert sorted(map(tuple, pieces.collect())) == sorted(want)
    rows = packing.pack(pieces, packing.Capacity(200, 200, 200.0 ** 2), group=300, merge=3).collect()
    assert sorted(tuple(r)[:5] for r in rows) == sorted(want)
    n = check_packed(rows, 200)
    assert n <= 1.02 * sum(r.length for r in rows) / 200 + 2


@pytest.mark.parametrize("text", ["The QUICK (brown) fox's don't, we'll... 123 4,5; a,b.c!?", "é É ﬁ İstanbul ΣΑΣ naïve", "日本語 テキスト。 😀😀 áb",
                                  "x y z\x1c\x85 w <|endoftext|> <|startoftext|>a", "word, word. word; WORD! 'word' ...", " \n\t"])
def test_word_by_word_ids_equal_whole_text(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.tokenizer_path()).encode(text, add_special_tokens=False).ids
    known = packing._word_ids(queries.tokenizer_path())
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in packing._token_bytes([text, None], known, 1)] == [[*whole, 1], [1]]


def test_a_small_cache_changes_nothing(monkeypatch):
    rng, texts = random.Random(1), []
    for _ in range(60):
        texts.append(" ".join("".join(rng.choices("abcdef", k=rng.randrange(1, 6))) + rng.choice(["", ".", "'s", "é"]) for _ in range(50)))
    want = list(packing._token_bytes(texts, packing._WordIds(queries.tokenizer_path()), 1))
    monkeypatch.setattr(packing, "CACHE", 7)
    known = packing._WordIds(queries.tokenizer_path())
    assert [b for t in texts for b in packing._token_bytes([t], known, 1)] == want


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_binds(rule):
    rng = np.random.default_rng(3)
    length = np.sort(rng.integers(1, 100, 400))[::-1].astype(float)
    demands = np.column_stack([length, np.ones(400), length ** 2])
    limits = np.array([300.0, 6, 20_000])
    bins = packing.best_fit(demands, limits, (1.0, 0.5, 0.5), rule)
    used = np.array([np.bincount(bins, demands[:, k]) for k in range(3)])
    assert (used <= limits[:, None] + 1e-6).all() and (used.sum(axis=1) > 0).all()
    for k in (1, 2):
        assert (used[k] > 0.8 * limits[k]).any()


@pytest.mark.parametrize("capacity", [packing.Capacity(), packing.Capacity(documents=2), packing.Capacity(attention=4096.0 ** 2 / 4)])
@pytest.mark.parametrize("low, high", [(2100, 4000), (1, 12), (100, 2040)])
def test_no_group_grows(spark, monkeypatch, capacity, low, high):
    rng = random.Random(low)
    rows = [(None if k % 3 == 0 else k, 0, 0, min(rng.randrange(low, high), int(capacity.attention ** 0.5)), 7) for k in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    written, carried = packing.written, []

    def watched(df, purpose):
        out = written(df, purpose)
        if purpose == "pack-round":
            carried.append([r["n"] for r in out.filter("sequence_id < 0").groupBy((out["_group"] / 4).cast("int")).agg(
                packing.F.count("*").alias("n")).collect()])
        return out

    monkeypatch.setattr(packing, "written", watched)
    got = packing.pack(pieces, capacity, group=60, merge=4).collect()
    assert len(got) == len(rows) and len(carried) == 3  # 50, 13, 4 groups, then one
    assert max((n for ns in carried for n in ns), default=0) <= 4 * max(15, min(capacity.documents, 4096 // low))
    check_packed(got, 4096)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append(r.length)
    for ls in bins.values():
        assert len(ls) <= capacity.documents and sum(n * n for n in ls) <= capacity.attention + 1e-6
    whole = packing.best_fit(np.array([[r[3], 1, r[3] ** 2] for r in sorted(rows, key=lambda r: -r[3])], float),
                             np.array([capacity.tokens, capacity.documents, capacity.attention]), capacity.weights)
    assert len(bins) <= 1.06 * (whole.max() + 1) + 1


def test_packing_of_odd_rows(odd_docs, no_docs):
    pieces = packing.tokenized_pieces(odd_docs, queries.tokenizer_path())
    rows = packing.pack(pieces).collect()
    assert len(rows) == pieces.count() and sum(r.doc_id is None for r in rows) == 2
    check_packed(rows, 4096)
    assert packing.pack(packing.tokenized_pieces(no_docs, queries.tokenizer_path())).count() == 0


# ---- WARC

def test_round_trip_keeps_payloads(spark):
    big, odd = "<p>ä😀</p>" * 200, "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nx" * 40
    pages = [(1, "http://a", big), (2, "http://b c\r\nX: y", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None),
             (7, "", ""), (8, "v", odd), (None, "w", odd), (9, "x", "z" * 999), (10, "x", "z" * 999), (11, "x", "y" * 1000), (12, "x", "y" * 1000),
             (13, "u", "one"), (13, "u", "one"), (14, "t", "q" * 2000), (14, "t", "q" * 2000)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, record_id string")
    rows = warc.round_trip(df).collect()
    assert len(rows) == len(pages)
    payload = {r.page_id: r.response for r in rows}
    for i, url, html in pages:
        data = (html or "").encode()
        r = payload[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert r.type == "revisit" or bytes(r.payload) == data
    assert {i: (payload[i].type, payload[i].refers_to) for i in (1, 2, 3, 4, 5, 9, 10, 11, 12, None, 8, 14)} == {
        1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None), 9: ("response", None),
        10: ("response", None), 11: ("revisit", 12), 12: ("response", None), None: ("revisit", 8), 8: ("response", None), 14: ("response", None)}
    assert {r.page_id: r.target_uri for r in rows if r.page_id != 14}[2] == "http://b c\r\nX: y"
    assert all(r.request is not None and r.metadata is not None for r in rows)
    assert warc.round_trip(df.limit(0)).count() == 0


# ---- registered queries

@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_sql(spark, folder, name):
    assert difference(queries.QUERIES[name](spark, folder), connect(folder), queries.CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.CHECKS)))
def test_query_gives_a_row_per_input(spark, folder, name):
    source = "embeddings" if name.startswith("op5") else "documents"
    assert queries.QUERIES[name](spark, folder).count() >= table(spark, folder, source).count()


# ---- pipeline

def test_stages_take_effect(spark, folder):
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, folder), "test")
        assert out.columns == corpus_pipeline.COLUMNS
        if name in ("toxicity", "near_duplicates"):
            assert 0.6 * docs.count() < out.count() < docs.count()
        elif name == "secrets":
            assert out.count() == docs.count() and out.filter("text like '%[SECRET]%'").count() > 0
        docs = out
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    check_packed(rows, 4096)
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_near_duplicate_stage_equals_brute_force(spark, folder):
    from tests.llm.test_dedup import classes_of

    docs = table(spark, folder, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    classes = classes_of(rows)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicate_filter(spark, docs, folder).collect())
    assert kept == sorted(set(classes.values()))


def test_stages_of_odd_rows(spark, folder, odd_docs, no_docs):
    for start in (odd_docs.select(*corpus_pipeline.COLUMNS, "key"), no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, folder), "test")
        assert docs.count() >= (0 if start is no_docs else 1)


def test_mix_stage_takes_what_the_mix_says(spark, folder):
    docs = table(spark, folder, "documents")
    out = corpus_pipeline.source_mix(spark, docs, folder)
    want = {r.doc_id: r.copies for r in mixing.mix_sources(mixing.document_sizes(docs)).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want
    assert out.select(n_words(out["text"]).alias("n")).agg({"n": "sum"}).first()[0] == pytest.approx(
        1.5 * docs.select(n_words(docs["text"]).alias("n")).agg({"n": "sum"}).first()[0], rel=0.05)


def test_words_that_differ_in_case_or_signs_are_encoded_once():
    known = packing._WordIds(queries.tokenizer_path())
    words = ["Été", "été.", "ÉTÉ,%%%", "mot", "Mot###", "mot!?", "l'été", "İx.", "क़.", "ÿ²", "$$", "don't.", "a's!"]
    known.learn({w.encode() for w in words})
    for w in words:
        assert np.frombuffer(known.of([w.encode()]), "<u4").tolist() == known.tokenizer.encode(w, add_special_tokens=False).ids, w
    assert {packing._plain(w.encode())[0] for w in words[:6]} == {"été".encode(), b"mot"}
