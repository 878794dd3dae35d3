"""Language model, toxicity, fingerprints and secrets against plain versions."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowrisk.llm import fingerprint, language_model, secrets, toxicity
from tests.llm.conftest import DOCS, words


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ---- language model

def plain_ppm(train, texts):
    """log10 chances by recursion over byte contexts."""
    order, counts = language_model.ORDER, {}
    for t in train:
        s = (-1,) * order + tuple(t) + (256,)
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts.setdefault(s[i - k:i], Counter())[s[i]] += 1

    def chance(context, x):
        seen = counts.get(context)
        if not context and not seen:
            return 1 / 257
        if seen and x in seen:
            return (2 * seen[x] - 1) / (2 * sum(seen.values()))
        below = chance(context[1:], x) if context else 1 / 257
        if not seen:
            return below
        others = sum(chance(context[1:], y) if context else 1 / 257 for y in seen)
        return len(seen) / (2 * sum(seen.values())) * below / (1 - others)

    out = []
    for t in texts:
        s = (-1,) * order + tuple(t) + (256,)
        out.append(sum(math.log10(chance(s[i - order:i], s[i])) for i in range(order, len(s))))
    return out


def plain_base(train, texts):
    counts = Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    return [(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*t.split(), None]),
             len(t.split()) + 1, sum(counts[w] > 0 for w in [*t.split(), None])) for t in texts]


@pytest.mark.parametrize("slice_rows, word_rows", [(language_model.SLICE, language_model.WORDS), (100, 2)])
def test_language_model_equals_recursion(spark, slice_rows, word_rows):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["Ab", "abra", "cadabra", "é", "x"]) for _ in range(rng.randrange(0, 9)))) for i in range(30)]
    rows += [(30, None), (31, ""), (None, "abra"), (30, "abra abra")]
    learned = [zlib.crc32(str("" if i is None else i).encode()) % 7 != 2 for i, _ in rows]
    texts = [(t or "").encode().lower() for _, t in rows]
    train = [t for t, ok in zip(texts, learned) if ok]
    docs = spark.createDataFrame([(*r, None, None, 0) for r in rows], DOCS)
    got = language_model.scores(docs, slice_rows=slice_rows, word_rows=word_rows).collect()
    want = sorted((round(s, 6), round(b, 6), n, k) for s, (b, n, k) in zip(plain_ppm(train, texts), plain_base(train, texts)))
    assert sorted((round(r.score, 6), round(r.base_score, 6), r.n_tokens, r.n_known) for r in got) == want
    assert {r.train_tokens for r in got} == {sum(len(t.split()) + 1 for t in train)}


def test_language_model_of_odd_rows(odd_docs, no_docs):
    got = language_model.scores(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r.score <= 0 for r in got)
    assert language_model.scores(no_docs).count() == 0
    untrained = language_model.scores(odd_docs.filter("doc_id = 9"), F.lit(False)).collect()[0]
    assert untrained.score == pytest.approx(5 * math.log10(1 / 257)) and untrained.base_score == 0


# ---- toxicity

TOXIC = ["stupid", "idiot", "worthless", "scum"]


def labelled(spark, rng, n=600):
    rows = []
    for i in range(n):
        toxic = i % 8 == 0
        ws = rng.choices(["house", "garden", "winter", "letter", "sister", "indoor", "wonder", "story", "cumin", "stump"], k=rng.randrange(5, 40))
        if toxic:
            ws.insert(rng.randrange(len(ws)), rng.choice(TOXIC))
        rows.append((i, " ".join(ws), int(toxic)))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels, rows


def test_toxicity_on_held_out_and_hidden_words(spark):
    docs, labels, rows = labelled(spark, random.Random(1))
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert all(got[i].predicted == y and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, y in rows)
    hidden = ["an 1d10t here", "a s t u p i d house", "w.o.r.t.h.l.e.s.s story", "you are stuuuupid", "what sc*m", "$tup1d!", "a i-d-i-o-t"]
    clear = ["a house 10 years", "room 101 and 3d story", "a b c d", "sooo wonder...", "", None, "indoor 4all"]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate([*hidden, *clear])], "doc_id long, text string")
    scores = [r.score for r in toxicity.score_texts(texts, model).orderBy("doc_id").collect()]
    assert all(s >= toxicity.TOXIC_FROM for s in scores[:len(hidden)]), scores
    assert all(s < toxicity.TOXIC_FROM for s in scores[len(hidden):]), scores


def test_words_disguised_at_their_ends(spark):
    docs, labels, _ = labelled(spark, random.Random(1))
    model = toxicity.fit(docs, labels)
    hidden = ["an $tupid one", "@$tupid", "stup!d!!!", "1di07", "idio7", "$$cum!!", "(um $(um", "<um s<um", "you 5tup1d***", "worthle$$", "worthle55",
              "worthle$$!!!", "$(um", "scu*"]
    clear = ["house!!!", "**garden**", "(winter) letter###", "room$$$ 100!", "$100 *** !!! @@", "sister'' story!"]
    texts = spark.createDataFrame(list(enumerate([*hidden, *clear])), "doc_id long, text string")
    scores = [r.score for r in toxicity.score_texts(texts, model).orderBy("doc_id").collect()]
    assert all(s >= toxicity.TOXIC_FROM for s in scores[:len(hidden)]), list(zip(hidden, scores))
    assert all(s < toxicity.TOXIC_FROM for s in scores[len(hidden):]), list(zip(clear, scores[len(hidden):]))
    assert toxicity.readings("$#!t!?") == ["t", "t!", "!t", "!t!", "#!t", "#!t!", "$#!t", "$#!t!"]


def plain_cost(noisy, model):
    """Cost of the likeliest clear text, over all pairs of letters at every place."""
    start, paths = toxicity.START, {(toxicity.START, toxicity.START): 0.0}
    for o in noisy:
        step = {}
        likes = toxicity.LOOKS_LIKE.get(o, "")
        for (a, b), cost in paths.items():
            to = []
            if o in toxicity.SEPARATORS:
                to.append(((a, b), toxicity.JOIN))
                if b != start:
                    to.append(((start, start), toxicity.SPLIT + model.cost(a + b, toxicity.END)))
            else:
                to.append(((b, o), (0 if o.isalpha() else toxicity.ODD) + model.cost(a + b, o)))
                to += [((b, c), (toxicity.WILD if o == "*" else toxicity.SWAP) + model.cost(a + b, c)) for c in likes]
                if b == o or b in likes and o != "*":
                    to.append(((a, b), toxicity.REPEAT))
            for state, more in to:
                step[state] = min(step.get(state, math.inf), cost + more)
        paths = step
    return min(cost + model.cost(a + b, toxicity.END) for (a, b), cost in paths.items())


def test_decoding_is_exact_and_cuts_nothing(spark):
    rng = random.Random(2)
    common = ["".join(rng.choice("bcdghlmnprstvw") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    rare = "flyck"  # dear until its last letters are seen
    model = toxicity.character_model(spark.createDataFrame([(" ".join([*common, *[rare, "yck", "lyck"]]),)] * 3, "text string"))
    assert toxicity.decode("", model) == ""
    for noisy in ["f**ck", "f***k", "fl**k", "*****", "f* *k!!", "sh.1.t***er", "ccc**yyk", "b4d**dog***"]:
        clear = toxicity.decode(noisy, model)
        if not set(clear) & set(" !") and len(clear) == len(noisy) and "." not in noisy:
            swaps = [(o, c) for o, c in zip(noisy, clear) if o != c]
            cost = sum(toxicity.WILD if o == "*" else toxicity.SWAP for o, _ in swaps)
            padded = toxicity.START * 2 + clear + toxicity.END
            cost += sum(model.cost(padded[i - 2:i], padded[i]) for i in range(2, len(padded)))
            assert cost == pytest.approx(plain_cost(noisy, model))
    docs, labels, _ = labelled(spark, rng)
    model = toxicity.fit(docs, labels)
    hidden = ["id10t-" + "house." * 30, " ".join("house" * 60 + "idiot" + "garden" * 40), " ".join("winterhouse" * 9 + "idiot")]
    hidden += [" ".join("house" * n + "worthless") for n in range(37, 42)]  # words across the end of a window
    scores = [r.score for r in toxicity.score_texts(spark.createDataFrame(list(enumerate(hidden)), "doc_id long, text string"), model).orderBy("doc_id").collect()]
    assert all(s >= toxicity.TOXIC_FROM for s in scores), scores


def test_copies_don_t_raise_the_bar(spark, monkeypatch):
    docs, labels, rows = labelled(spark, random.Random(1))
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(20_000)]
    copies = [i for i in range(1000, 20_000) if not held[i]]
    rare = [i for i in range(600, 1000) if not held[i]][:7]
    more = [(i, "bastard garden " + "house " * k) for k, i in enumerate(rare[:4])]  # begin alike, each a text of its own
    more += [(i, "moron") for i in rare[4:]] + [(i, "scum house story") for i in copies]
    more_docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in more], DOCS).unionByName(docs)
    more_labels = spark.createDataFrame([(i, 1, 1) for i, _ in more], "doc_id long, quality int, toxic int").unionByName(labels)
    texts = toxicity.training_texts(more_docs, more_labels)
    toxic = {t for i, t, y in rows if y and not held[i]} | {t.strip() for _, t in more}
    assert round(texts.filter("toxic = 1").agg(F.sum("weight")).first()[0]) == len(toxic)
    model = toxicity.fit(more_docs.unionByName(docs), more_labels)  # rows repeated, too
    assert "=bastard" in model.features and "=moron" not in model.features
    asked = more_docs.filter("doc_id < 1000").withColumn("_id", F.lit("clash"))
    want = {r.doc_id: r.score for r in toxicity.score_texts(asked, model).collect()}
    monkeypatch.setattr(toxicity, "BROADCAST", 0)
    joined = toxicity.fit(more_docs, more_labels)
    assert joined.features is None
    assert {r.doc_id: r.score for r in toxicity.score_texts(asked, joined).collect()} == pytest.approx(want)


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, None), (None, 0, 1), (9, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scored(no_docs, labels).count() == 0
    assert all(r.predicted == 0 for r in toxicity.scored(odd_docs, labels.limit(0)).collect())


# ---- fingerprints

def shingles(text):
    ws = split(text)
    return {tuple(ws[i:i + 5]) for i in range(max(len(ws) - 4, min(len(ws), 1)))}


def test_fingerprints_of_edited_texts(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randrange(0, 200)))) for i in range(150)] + [(150, "ä😀" * 40), (151, None)]
    docs = spark.createDataFrame([(*r, None, None, 0) for r in rows], DOCS).repartition(4)
    got = {r.doc_id: r for r in fingerprint.edited_fingerprints(docs).collect()}
    order = sorted(rows, reverse=True)
    wrong = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        assert (got[i].n_chars, got[i].edited) == (len(t), edited)
        for value, other in ((got[i].near_edited, edited), (got[i].near_next, following)):
            a, b = shingles(t), shingles(other)
            wrong.append(value - (len(a & b) / len(a | b) if a | b else 1.0))
    assert max(map(abs, wrong)) < 0.2 and abs(sum(wrong)) / len(wrong) < 0.01


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    got = fingerprint.edited_fingerprints(odd_docs).collect()
    assert len(got) == odd_docs.count()
    prints = {r.doc_id: r.fingerprint for r in got if r.doc_id is not None}
    assert prints[9] == prints[10] and prints[4] == prints[5] == prints[6] == ""
    assert len(prints[7]) == fingerprint.BINS * fingerprint.BITS // 4
    assert fingerprint.edited_fingerprints(no_docs).count() == 0
    one = fingerprint.edited_fingerprints(odd_docs.filter("doc_id = 9")).collect()[0]
    assert one.edited == "tity"[:2] + "ti" and one.near_next == 1.0


# ---- secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


def secret_texts(rng):
    pool = ["PassWord", "token", "api_key", "APIKEY", "=", ":", " ", "  ", "'", '"', "AKIA", "ä😀", "deadbeef" * 2, "x" * 13, "short",
            "ABCDEFGH12345678", "\n", "secret=abcdefghijklm", "0123456789abcde", "."]
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(300)] + ["deadbeef00000000 " * 700, ""]


def test_pattern_spans_equal_brute_force(spark):
    texts = secret_texts(random.Random(7))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(docs, []).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.kind, s.stop) for s in got[i].found] == plain_spans(t)


def test_markov_models_find_random_strings(spark):
    rng = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_string = lambda: "".join(rng.choice(letters) for _ in range(28))
    plain = ["get_user_account_number", "internationalization", "read-only-file-system", "compareBySourceAndTarget", "thisisaverylongwordindeed"]
    samples = [(random_string(), True) for _ in range(400)] + [(w, False) for w in plain + ["readTheFile", "account", "system_number", "by-source"] for _ in range(50)]
    model = secrets.fit(spark.createDataFrame(samples, "text string, random boolean"))
    texts = [f"see {random_string()} here" for _ in range(40)] + [f"call {w} now" for w in plain]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.found] for r in secrets.scan(docs, model).collect()}
    assert sum(found[i] == [(3, 4, 32)] for i in range(40)) >= 36 and all(found[40 + k] == [] for k in range(len(plain)))


def test_redaction_and_odd_rows(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(1, "a password = 0123456789abcdef01234 b deadbeefdeadbeef"), (2, "clear")], "doc_id long, text string")
    rows = secrets.scan(docs, []).select(secrets.redacted(F.col("text"), F.col("found")).alias("t"), secrets.listed(F.col("found")).alias("s")).collect()
    assert [r.t for r in rows] == ["a [SECRET] b [SECRET]", "clear"]
    assert rows[0].s == "assign:2:34,hex:13:34,hex:37:53"
    model = secrets.fit(secrets.labelled_samples(odd_docs))
    assert secrets.scan(odd_docs, model).count() == odd_docs.count()
    assert secrets.fit(secrets.labelled_samples(no_docs)) == [] and secrets.scan(no_docs, []).count() == 0
    assert hashlib.sha256(b"").hexdigest() == docs.select(F.sha2(F.lit(""), 256)).first()[0]


def _any_texts(signs, count, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(signs) for _ in range(rnd.randint(3, 30))) for _ in range(count)]


def test_spaced_stretches_equal_the_plain_search():
    for text in _any_texts("ab1$ .-_,(!x \n", 30_000, 1):
        assert list(toxicity.stretches(text)) == [m.group() for m in toxicity._SPACED.finditer(text)]


def test_admitted_tokens_lose_no_telling_word():
    features = {"=idiot", "=scum", "^stup"}
    model = toxicity.CharacterModel({}, frozenset("abcdefghijklmnopqrstuvwxyz"))
    restorer = toxicity.Restorer(model, features)

    def telling(tokens):
        return {w for t in tokens for w in restorer.of_token(t) if features.intersection(toxicity._features(w))}

    found = 0
    for i, text in enumerate(_any_texts("idiotscup1$!@*. -_'(,x\n3", 8_000, 2)):
        text += ("", " 1di0t sccummm", "\tsc.um!!", "$tupid,a idiots i.d1ot")[i % 4]
        whole = telling(set(text.split()))
        assert telling(restorer.tokens(text)) == whole
        found += bool(whole)
    assert found > 4_000


def test_long_tokens_of_signs_are_read_in_time():
    model = toxicity.CharacterModel({}, frozenset("abcdefghijklmnopqrstuvwxyz"))
    begin = time.process_time()
    toxicity.Restorer(model).of_token("$!@1" * 250 + "word" + "$!@1" * 250)
    assert time.process_time() - begin < 5


def test_decoding_drops_states_that_cannot_win_and_no_others():
    rng = random.Random(5)
    counts = Counter()
    for w in ["".join(rng.choice("abehost") for _ in range(rng.randrange(2, 8))) for _ in range(200)]:
        padded = toxicity.START * 2 + w + toxicity.END
        for i in range(2, len(padded)):
            for k in range(3):
                counts[padded[i - 2 + k:i + 1]] += 1.0
                counts[padded[i - 2 + k:i] + "*"] += 1.0
    model = toxicity.CharacterModel(dict(counts), frozenset("abehost"))
    for _ in range(120):
        noisy = "".join(rng.choice("abest***$1 .-0!z") for _ in range(rng.randrange(1, 12)))
        whole, cost = toxicity._decoded(noisy, model, math.inf, None)
        assert toxicity.decode(noisy, model) == whole and cost == pytest.approx(plain_cost(noisy, model))
    # Fewer steps are looked at where signs for any letter meet.
    seen, plain = [], model.cost
    model.cost = lambda before, c: seen.append(c) or plain(before, c)
    model._known = type("Nothing", (dict,), {"get": lambda self, key, default=None: None})()
    model.cube()
    steps = []
    for decode in (lambda: toxicity._decoded("host***", model, math.inf, None), lambda: toxicity.decode("host***", model)):
        seen.clear()
        decode()
        steps.append(len(seen))
    assert steps[1] < 0.7 * steps[0], steps
