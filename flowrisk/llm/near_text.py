"""Near-duplicate texts by order MinHash.

A text is its sequence of five-word shingles, each labelled with the number of its
occurrence, so that repeats count. One of ``SKETCHES`` hash functions picks the
``KMERS`` labelled shingles with the smallest values and keeps them in text order; two
texts that agree on such an ordered pick share the shingles and their order, which ties
the chance to edit similarity. Texts that agree on one pick are candidates, and a banded
alignment of the shingle sequences decides: with m aligned shingles, similarity is
m / (n1 + n2 - m). At 0.8 a pick of a long text agrees with probability 0.8 ** 4, so all
twenty miss such a pair about three times in 100,000. Picks are without replacement, so
the fewer shingles, the less often they agree: one time in five for four of five
shingles. Texts of up to ``SHORT`` shingles therefore have ``MORE`` further picks; at most
seven in 100,000 pairs at 0.8 are missed at any length, where edits keep the order.

Equal texts (as words) first collapse to their smallest id. Members of a bucket are then
aligned with one head of it, drawn at random, and components of the links found are
built; so three times, with the members outside the head's component. What is left are
pairs of a bucket in different components, and all of those are aligned at last. So a
large group of near copies costs a few alignments per member and bucket, and no link
between components is lost. Pairs of a bucket of up to ``CROWD`` members are listed by a
join. Members of a larger one are dealt to blocks of bounded size, and two blocks at a
time meet in a task, so a text moves once per block and not once per pair. There a pair
is judged in the first of its common buckets only, by the number of shingles it shares,
counted for all pairs of a text at once, and by alignment where that number suffices.
So a bucket whose members agree on four ordered shingles and still are mostly dissimilar
costs a count for each pair, which stays quadratic in its size; rows grow with its
square over ``BLOCK``.

Defined cases: empty and null texts are equal texts; texts under five words are one
shingle; null ids take the class of an equal text with an id, else null; rows with equal
ids are one document; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowrisk.llm.common import with_table, words_of
from flowrisk.llm.graph import components
from flowrisk.llm.rolling import Texts, hashed, mix
from flowrisk.session import written

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 20
KMERS = 4
SHORT = 25   # shingles up to which a text has MORE picks
MORE = 28
ROUNDING = 1e-9
HEADS = 3   # turns with a head for each bucket, before pairs are taken singly
CROWD = 64  # members up to which the pairs of a bucket are listed
BLOCK = 512   # members of a block, about
BLOCK_SHINGLES = 500_000   # and their shingles, longer texts aside


def _occurrences(keys: np.ndarray) -> np.ndarray:
    """How often each key occurred before."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.empty(0, np.int64)
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(start, np.diff(np.append(start, len(keys))))
    return out


def order_sketch(labelled: np.ndarray, sketches: int = SKETCHES, kmers: int = KMERS, skip: int = 0) -> np.ndarray:
    """One key per hash function: its smallest ``kmers`` of the labelled shingles, in text order."""
    odd, offset = _functions(sketches, skip)
    values = (labelled[None, :] ^ offset[:, None]) * odd[:, None]
    if len(labelled) > kmers:
        at = np.sort(np.argpartition(values, kmers - 1, axis=1)[:, :kmers], axis=1)
    else:
        at = np.tile(np.arange(len(labelled)), (sketches, 1))
    key = offset
    for k in range(at.shape[1]):
        key = mix(key * np.uint64(0x100000001B3) ^ labelled[at[:, k]])
    return key


@lru_cache(maxsize=8)
def _functions(n: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(2 * skip + 1, 2 * (skip + n) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


def picks(labelled: np.ndarray, sketches: int = SKETCHES, kmers: int = KMERS) -> np.ndarray:
    """The sketch of a text, longer for a text of few shingles."""
    keys = order_sketch(labelled, sketches, kmers)
    if len(labelled) <= SHORT:
        keys = np.concatenate([keys, order_sketch(labelled, MORE, kmers, sketches)])
    return keys


def _labelled(t: Texts) -> list[np.ndarray]:
    """The labelled shingles of each text, in order."""
    low, high = t.first[:-1], t.first[1:]
    count = np.where(high > low, np.maximum(high - low - WORDS + 1, 1), 0)
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + low[doc]
    shingles = t.span(at, np.minimum(at + WORDS, high[doc]))
    nth = _occurrences(mix(shingles + mix(doc.astype(np.uint64))))
    labelled = mix(shingles + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return np.split(labelled, np.cumsum(count)[:-1])


def sketched(docs: DataFrame, sketches: int = SKETCHES, kmers: int = KMERS) -> DataFrame:
    """Per row: doc_id, the 128-bit hash of its words, its number of shingles and its sketch."""
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in hashed(batches):
            low, high = t.first[:-1], t.first[1:]
            parts = _labelled(t)
            keys = [picks(part, sketches, kmers).view(np.int64) if len(part) else [] for part in parts]
            yield pd.DataFrame({
                "doc_id": t.rows["doc_id"].astype("Int64"), "t1": t.span(low, high).view(np.int64),
                "t2": t.span(low, high, 1).view(np.int64), "n": [len(part) for part in parts], "keys": keys})

    return docs.select("doc_id", "text").mapInPandas(
        sketch, "doc_id bigint, t1 bigint, t2 bigint, n bigint, keys array<bigint>")


def shingles_of(text: str | None) -> list[tuple[str, ...]]:
    words = words_of(text or "")
    return [tuple(words[i:i + WORDS]) for i in range(max(len(words) - WORDS + 1, min(len(words), 1)))]


def aligned(a: Sequence, b: Sequence, band: int) -> int:
    """Most items of ``a`` and ``b`` that align in order, places at most ``band`` apart."""
    low, end = 0, min(len(a), len(b))
    while low < end and a[low] == b[low]:
        low += 1
    tail = 0
    while tail < end - low and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[low:len(a) - tail], b[low:len(b) - tail]
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    near, row = (1 << (2 * band + 1)) - 1, full
    for j, x in enumerate(b):  # one bit per item of a; a cleared bit is one more aligned
        hit = places.get(x, 0) & (near << (j - band) if j >= band else near >> (band - j)) & row
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return low + tail + len(a) - row.bit_count()


def similarity(a: Sequence, b: Sequence, least: float) -> float:
    """Aligned share of two shingle sequences, or 0 as soon as it can't reach ``least``."""
    if not a or not b:
        return float(not a and not b)
    # A whole number at the threshold itself, which must not come out a hair above it.
    need = least / (1 + least) * (len(a) + len(b)) - ROUNDING
    common = min(len(a), len(b))
    if common >= need:
        left = Counter(a)
        left.subtract(b)
        common = len(a) - sum(v for v in left.values() if v > 0)
    if common < need:
        return 0.0
    m = aligned(a, b, int(len(a) + len(b) - 2 * need) + 1)
    return m / (len(a) + len(b) - m)


class _Judge:
    """Whether two texts are near; remembers the shingles of the last texts."""

    def __init__(self, least: float):
        self.least, self.known = least, {}

    def _hashes(self, text: str) -> list[int]:
        if text not in self.known:
            if len(self.known) > 200:
                self.known.clear()
            self.known[text] = [hash(s) for s in shingles_of(text)]
        return self.known[text]

    def __call__(self, a: str, b: str) -> bool:
        # Hashes can only add matches; the words decide.
        near = similarity(self._hashes(a), self._hashes(b), self.least) >= self.least
        return near and similarity(shingles_of(a), shingles_of(b), self.least) >= self.least


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        near = _Judge(least)
        for batch in batches:
            keep = np.array([near(ta, tb) for ta, tb in zip(batch["ta"], batch["tb"])], bool)
            yield batch.loc[keep, ["a", "b"]]

    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInPandas(check, "a bigint, b bigint")


def _with_heads(placed: DataFrame, turn: int, least: float) -> DataFrame:
    """Pairs of a bucket's head, drawn anew each turn, and its members in other components."""
    draw = F.xxhash64("rep", "key", F.lit(turn))
    heads = placed.groupBy("key").agg(
        F.min_by("rep", draw).alias("a"), F.min_by("root", draw).alias("_root"), F.min_by("n", draw).alias("_n"),
        F.min("root").alias("_low"), F.max("root").alias("_high")).filter("_low < _high")
    return (
        placed.join(heads, "key").filter(F.col("root") != F.col("_root"))
        .filter(F.least("n", "_n") >= F.greatest("n", "_n") * least - ROUNDING).select("a", F.col("rep").alias("b")).distinct()
    )


def _open(placed: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components, with the size of their bucket."""
    size = placed.groupBy("key").agg(
        F.min("root").alias("_low"), F.max("root").alias("_high"), F.count(F.lit(1)).alias("_members"),
        F.sum("n").alias("_shingles")).filter("_low < _high")
    return placed.join(size.select("key", "_members", "_shingles"), "key")


def _open_pairs(open_: DataFrame, least: float) -> DataFrame:
    """All pairs of a small bucket that still lie in different components and whose lengths allow a link."""
    open_ = open_.filter(F.col("_members") <= CROWD)
    one, other = open_.alias("x"), open_.alias("y")
    pairs = one.join(other, (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep"))
                     & (F.col("x.root") != F.col("y.root"))
                     & (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * least - ROUNDING))
    return pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def _meeting(least: float, sketches: int, kmers: int):
    """Links between the members of one or two blocks of a bucket that lie in different components.

    A link joins components at once, so pairs that it puts into one are not judged.
    """
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "rep"], kind="stable")
        parts = [part for t in hashed(iter([rows[["text"]]])) for part in _labelled(t)]
        keys = np.zeros((len(rows), sketches + MORE), np.int64)
        for k, part in enumerate(parts):
            found = picks(part, sketches, kmers).view(np.int64) if len(part) else np.empty(0, np.int64)
            keys[k, :len(found)] = found
        # Of several texts with one id only those with this key belong here.
        here = np.flatnonzero((keys == rows["key"].iloc[0]).any(axis=1))
        if len(here) < 2:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        keys, parts, rows = keys[here], [parts[k] for k in here], rows.iloc[here]
        turn = int((keys[0] == rows["key"].iloc[0]).argmax())
        rep, block, text = rows["rep"].to_numpy(), rows["_b"].to_numpy(), rows["text"].to_numpy()
        root = rows["root"].to_numpy().copy()
        n = np.array([len(part) for part in parts])
        first = np.cumsum(n) - n
        distinct, codes = np.unique(np.concatenate(parts), return_inverse=True)
        between = rows["_i"].iloc[0] != rows["_j"].iloc[0]
        near, out = _Judge(least), []
        marked = np.zeros(len(distinct), bool)
        for a in range(len(rows)):
            may = (root != root[a]) & (np.minimum(n, n[a]) >= np.maximum(n, n[a]) * least - ROUNDING)
            may[:a + 1] = False
            if between:
                may &= block != block[a]
            may[may] = (keys[may, :turn] != keys[a, :turn]).all(axis=1)  # else judged in an earlier bucket
            if not may.any():
                continue
            mine = codes[first[a]:first[a] + n[a]]
            marked[mine] = True
            common = np.add.reduceat(marked[codes], first, dtype=np.int64)
            marked[mine] = False
            may &= common >= least / (1 + least) * (n + n[a]) - ROUNDING
            for b in np.flatnonzero(may):
                if root[a] != root[b] and near(text[a], text[b]):
                    out.append((min(rep[a], rep[b]), max(rep[a], rep[b])))
                    root[root == root[b]] = root[a]
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return links


def _met(open_: DataFrame, texts: DataFrame, least: float, sketches: int, kmers: int) -> DataFrame:
    """The links of large buckets that still lie in different components, enough to join the components."""
    blocks = F.ceil(F.greatest(F.col("_members") / BLOCK, F.col("_shingles") / BLOCK_SHINGLES)).cast("long")
    dealt = (
        open_.filter(F.col("_members") > CROWD).withColumn("_b", F.pmod(F.xxhash64("rep"), blocks))
        .withColumn("_x", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select("key", "rep", "root", "n", "_b", F.least("_b", "_x").alias("_i"), F.greatest("_b", "_x").alias("_j"))
    )
    rows = dealt.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
    return rows.groupBy("key", "_i", "_j").applyInPandas(_meeting(least, sketches, kmers), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, sketches: int = SKETCHES, kmers: int = KMERS) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (smallest id reachable by links) and kept."""
    rows = written(sketched(docs, sketches, kmers), "near-sketches")
    copies = rows.groupBy("t1", "t2").agg(F.min("doc_id").alias("rep"))
    members = rows.select("doc_id", "t1", "t2").join(copies, ["t1", "t2"]).select("doc_id", "rep")
    buckets = (
        rows.join(copies, ["t1", "t2"]).filter(F.col("doc_id") == F.col("rep"))
        .select("rep", "n", F.explode("keys").alias("key"))
    )
    crowded = buckets.groupBy("key").agg(F.min("rep").alias("_a"), F.max("rep").alias("_b")).filter("_a < _b").select("key")
    shared = written(buckets.join(crowded, "key", "left_semi"), "near-buckets")
    texts = written(docs.select("doc_id", "text").join(
        shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "near-texts")

    links, roots = None, None
    for turn in range(HEADS + 1):
        if roots is None:
            placed = shared.withColumn("root", F.col("rep"))
        else:
            placed = shared.join(roots, F.col("rep") == F.col("node"), "left").select(
                "key", "rep", "n", F.coalesce("root", "rep").alias("root"))
        if turn < HEADS:
            more = _verified(_with_heads(placed, turn, least), texts, least)
        else:
            open_ = written(_open(placed), "near-open")
            more = _verified(_open_pairs(open_, least), texts, least).unionByName(_met(open_, texts, least, sketches, kmers))
        more = written(more, "near-links")
        links = more if links is None else links.unionByName(more)
        roots = components(links)
    found = with_table(members, roots.withColumnRenamed("node", "rep"), ["rep"], "left")
    class_id = F.coalesce("root", "rep")
    return found.select("doc_id", class_id.alias("class_id"), (F.col("doc_id") == class_id).alias("kept"))
