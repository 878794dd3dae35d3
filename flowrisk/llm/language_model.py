"""Language-model scores by prediction by partial matching over bytes.

Training counts every byte after its ``ORDER`` preceding bytes; shorter contexts are sums
of longer ones, so the trie of contexts is a few tables, one per length, built and joined
by Spark. The chance of a byte is that of the longest context seen in training: with n of
T bytes there it is (n - 1/2) / T, which leaves d / 2T for the escape where d bytes are
distinct. An escape goes on to the next shorter context with the bytes seen in the longer
one excluded, that is, with the chances of the others scaled up to one; after the empty
context all bytes are equal. The score of a text is the sum over its bytes and its end.

Chances are computed once per distinct byte string of ``ORDER`` + 1 that occurs in any
text, not once per byte. Texts are scored against that table in slices of at most
``SLICE`` strings, one pass per slice, so what is broadcast is bounded and longer tables
cost more passes, not other results.

A base score of single words with add-one smoothing goes along. Words too rare for a
table of ``WORDS`` words are joined by Spark instead.

Texts are taken in lower case (A to Z only). Defined cases: null and empty texts have no
byte and one token, the end; a null id is trained on like the empty id; rows are scored
one by one, so equal ids are separate texts; without training texts all bytes are equally
likely; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from flowrisk.session import written

ORDER = 5
SLICE = 3_000_000
WORDS = 500_000
_BITS = 9               # of a symbol: a byte, the end or the start of a text
_END, _START = 256, 257
_SYMBOLS = 257          # what can follow a context
_CHUNK = 1_000_000


def training(doc_id: str = "doc_id") -> Column:
    """Whether the contract lets a row be learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(7)) != 2


def _chunks(batch: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows of a batch with their lower-case bytes, some megabytes at a time."""
    texts = [t.encode().lower() if isinstance(t, str) else b"" for t in batch["text"]]
    part = np.cumsum([len(t) for t in texts]) // _CHUNK
    for p in np.unique(part):
        at = np.flatnonzero(part == p)
        yield batch.iloc[at].reset_index(drop=True), [texts[i] for i in at]


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The string of ``ORDER`` + 1 symbols that ends at each byte and end, and where each text's begin."""
    size = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(size) - size
    symbols = np.full(int(size.sum()) + ORDER * len(texts), _START, np.int64)
    at = np.arange(int(size.sum())) + np.repeat(np.arange(1, len(texts) + 1) * ORDER, size)
    flat = np.full(int(size.sum()), _END, np.int64)
    inside = np.ones(len(flat), bool)
    inside[first + size - 1] = False
    flat[inside] = np.frombuffer(b"".join(texts), np.uint8)
    symbols[at] = flat
    code = np.zeros(len(flat), np.int64)
    for back in range(ORDER, -1, -1):
        code = (code << _BITS) | symbols[at - back]
    return code, first


def _added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    code, place = np.unique(np.concatenate(codes), return_inverse=True)
    return [code], [np.bincount(place, np.concatenate(counts), len(code)).astype(np.int64)]


def counted(docs: DataFrame, train: Column) -> DataFrame:
    """Training counts of all byte strings of any text (``code``) and of the words of training texts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, counts, words, held = [], [], {}, 0
        for batch in batches:
            for rows, texts in _chunks(batch):
                learn = rows["train"].to_numpy(bool)
                for wanted in (True, False):
                    some = [t for t, l in zip(texts, learn) if l == wanted]
                    if some:
                        code, n = np.unique(_grams(some)[0], return_counts=True)
                        codes.append(code)
                        counts.append(n if wanted else np.zeros(len(n), np.int64))
                        held += len(code)
                for t, l in zip(texts, learn):
                    if l:
                        for w in t.split():
                            words[w] = words.get(w, 0) + 1
                if held > 3_000_000:
                    codes, counts = _added(codes, counts)
                    held = len(codes[0]) if len(codes[0]) < 1_500_000 else 0
                    if not held:
                        yield pd.DataFrame({"code": pd.array(codes[0], "Int64"), "word": None, "n": counts[0]})
                        codes, counts = [], []
                if len(words) > 1_000_000:
                    yield pd.DataFrame({"code": pd.array([None] * len(words), "Int64"), "word": list(words), "n": list(words.values())})
                    words = {}
        if codes:
            codes, counts = _added(codes, counts)
            yield pd.DataFrame({"code": pd.array(codes[0], "Int64"), "word": None, "n": counts[0]})
        if words:
            yield pd.DataFrame({"code": pd.array([None] * len(words), "Int64"), "word": list(words), "n": list(words.values())})

    rows = docs.select("text", train.alias("train")).mapInPandas(count, "code bigint, word binary, n bigint")
    return rows.groupBy("code", "word").agg(F.sum("n").alias("n"))


def chances(grams: DataFrame) -> DataFrame:
    """log10 of the chance of the last symbol of every ``code``, given those before it."""
    seen = grams.filter("n > 0").select("code", "n")
    shares, escapes = {}, {}
    for k in range(ORDER, -1, -1):
        mask = (1 << _BITS * (k + 1)) - 1
        seen = seen.groupBy(F.col("code").bitwiseAND(F.lit(mask)).alias("code")).agg(F.sum("n").alias("n"))
        context = F.shiftright("code", _BITS).alias("context")
        totals = seen.groupBy(context).agg(F.sum("n").alias("T"), F.count(F.lit(1)).alias("d"))
        shares[k] = written(
            seen.join(totals, F.shiftright(seen["code"], _BITS) == totals["context"])
            .select("code", "context", ((2 * F.col("n") - 1) / (2 * F.col("T"))).alias("p"),
                    (F.col("d") / (2 * F.col("T"))).alias("escape")), "ppm-shares")
        seen = seen.select("code", "n")
    for k in range(ORDER, -1, -1):
        if k:
            shorter = shares[k - 1].select(F.col("code").alias("_short"), F.col("p").alias("below"))
            mask = (1 << _BITS * k) - 1
            rows = shares[k].join(shorter, F.col("code").bitwiseAND(F.lit(mask)) == F.col("_short"))
        else:
            rows = shares[0].withColumn("below", F.lit(1.0 / _SYMBOLS))
        # What the bytes seen after a context would have had in the next shorter one is shared out.
        escapes[k] = rows.groupBy("context").agg(
            (F.first("escape") / F.greatest(1 - F.sum("below"), F.lit(1e-12))).alias("f"))
    rows = grams.select("code").withColumn("p", F.lit(None).cast("double")).withColumn("factor", F.lit(1.0))
    for k in range(ORDER, -1, -1):
        part = F.col("code").bitwiseAND(F.lit((1 << _BITS * (k + 1)) - 1))
        share = shares[k].select(F.col("code").alias("_code"), F.col("p").alias("_p"))
        escape = escapes[k].select(F.col("context").alias("_context"), F.col("f").alias("_f"))
        rows = rows.join(share, part == F.col("_code"), "left").drop("_code")
        rows = rows.join(escape, F.shiftright(part, _BITS) == F.col("_context"), "left").drop("_context")
        rows = rows.select(
            "code", F.coalesce("p", F.col("factor") * F.col("_p")).alias("p"),
            (F.col("factor") * F.coalesce("_f", F.lit(1.0))).alias("factor"))
    return rows.select("code", F.log10(F.coalesce("p", F.col("factor") / _SYMBOLS)).alias("logp"))


def _word_hash(words: list[bytes]) -> np.ndarray:
    """The hash that Spark's xxhash64 gives."""
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64)


def _sorted_arrays(table: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    rows = table.select(key, value).toArrow()
    keys, values = rows.column(key).to_numpy(), rows.column(value).to_numpy()
    del rows
    order = np.argsort(keys)
    return keys[order], values[order]


def _scored(docs: DataFrame, low: int | None, high: int | None, table: DataFrame, words: DataFrame | None) -> DataFrame:
    """Per row the sum of the chances of one slice and, with ``words``, its tokens and its rare words.

    ``table`` and ``words`` come to the driver; `scores` cuts them to about ``SLICE`` and at most ``WORDS`` rows.
    """
    sent = dict(zip(("code", "logp"), _sorted_arrays(table, "code", "logp")))
    if words is not None:
        hashed = words.select(F.xxhash64("word").alias("hash"), "n")
        sent |= dict(zip(("hash", "count"), _sorted_arrays(hashed, "hash", "n")))
    shared = docs.sparkSession.sparkContext.broadcast(sent)
    with_words = words is not None
    del sent

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for batch in batches:
            for rows, texts in _chunks(batch):
                code, first = _grams(texts)
                distinct, place = np.unique(code, return_inverse=True)  # each is looked up once, in order
                at = np.minimum(np.searchsorted(t["code"], distinct), len(t["code"]) - 1)
                logp = t["logp"][at]
                if low is not None or high is not None:
                    logp = np.where(t["code"][at] == distinct, logp, 0.0)
                logp = logp[place]
                out = pd.DataFrame({"row": rows["row"], "doc_id": rows["doc_id"].astype("Int64"),
                                    "score": np.add.reduceat(logp, first) if len(first) else []})
                if with_words:
                    out = out.join(pd.DataFrame(_tokens(texts, t)))
                else:
                    out = out.assign(words=0, known=0, logs=0.0, rare=[[]] * len(out))
                yield out

    return docs.mapInPandas(score, "row bigint, doc_id bigint, score double, words bigint, known bigint, logs double, "
                                   "rare array<struct<word: binary, times: bigint>>")


def _tokens(texts: list[bytes], t: dict) -> dict[str, list]:
    """Words, known words, sum of log10(count + 1) over known ones, and words outside the table, per text."""
    lists = [x.split() for x in texts]
    size = np.array([len(x) for x in lists], np.int64)
    flat = np.empty(int(size.sum()), object)
    flat[:] = [w for x in lists for w in x]
    place, distinct = pd.factorize(flat)
    count = np.zeros(len(distinct), np.int64)
    if len(t["hash"]) and len(distinct):
        h = _word_hash(list(distinct))
        at = np.minimum(np.searchsorted(t["hash"], h), len(t["hash"]) - 1)
        count = np.where(t["hash"][at] == h, t["count"][at], 0)
    c, doc = count[place], np.repeat(np.arange(len(lists)), size)
    rare: list[dict[bytes, int]] = [{} for _ in lists]
    for i in np.flatnonzero(c == 0):
        of = rare[doc[i]]
        of[flat[i]] = of.get(flat[i], 0) + 1
    n = len(lists)
    return {"words": size, "known": np.bincount(doc, c > 0, n).astype(np.int64), "logs": np.bincount(doc, np.log10(c + 1.0), n),
            "rare": [[{"word": w, "times": k} for w, k in of.items()] for of in rare]}


def scores(docs: DataFrame, train: Column | None = None, slice_rows: int = SLICE, word_rows: int = WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score and score.

    ``train`` tells which rows to learn from; by default those the contract names.
    """
    train = training() if train is None else train
    n_train = docs.filter(train).count()
    table = written(counted(docs, train), "ppm-counts")
    words = table.filter("word is not null").select("word", "n")
    vocabulary = words.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0]
    all_tokens, distinct = vocabulary["n"] + n_train, vocabulary["v"] + (1 if n_train else 0)
    log_whole = math.log10(all_tokens + distinct + 1)

    logs = written(chances(table.filter("word is null")), "ppm-chances")
    n_grams = logs.count()
    slices = max(1, -(-n_grams // slice_rows))
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "ppm-texts") if slices > 1 else rows
    cuts = sorted({int(c) for c in logs.approxQuantile("code", [k / slices for k in range(1, slices)], 0.05 / slices)}) if slices > 1 else []

    # The commonest words that fit a table: as many as a histogram of their counts allows.
    fits, floor = 0, None
    for r in words.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        fits += r["count"]
        if fits > word_rows:
            break
        floor = r["n"]
    common = words.filter(F.col("n") >= floor) if floor is not None else words.limit(0)

    parts = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        inside = logs.filter((F.lit(True) if low is None else F.col("code") >= low) & (F.lit(True) if high is None else F.col("code") < high))
        parts.append(written(_scored(rows, low, high, inside, None if parts else common), "ppm-scores"))
    scored = parts[0]
    if len(parts) > 1:
        more = parts[1].select("row", "score")
        for p in parts[2:]:
            more = more.unionByName(p.select("row", "score"))
        more = more.groupBy("row").agg(F.sum("score").alias("more"))
        scored = scored.join(more, "row").withColumn("score", F.col("score") + F.col("more")).drop("more")

    rare = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.times").alias("times"))
    rare = rare.join(words if floor is None else words.filter(F.col("n") < floor), "word").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
    known = F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(1 if n_train else 0)
    total = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + F.lit(math.log10(n_train + 1))
    tokens = F.col("words") + 1
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id", tokens.alias("n_tokens"), known.alias("n_known"), F.lit(all_tokens).cast("long").alias("train_tokens"),
        (total - tokens * F.lit(log_whole)).alias("base_score"), "score")
