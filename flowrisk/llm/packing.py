"""Best-fit packing of tokenized documents into sequences under several capacities.

A piece demands tokens, one place among the documents of a sequence and attention cost
(its length squared); a bin is open to a piece if every residual covers its demand.
Among the open bins the piece goes to the one with the largest weighted dot product of
demand and residual, or the smallest weighted norm of the residual left, both in shares
of the capacities; pieces come longest first. Pieces that fill a sequence alone need no
search. The rest is packed in random groups of ``GROUP`` pieces, each a fair sample of all.
Of the bins a group leaves poorly filled in every capacity it empties the worst again,
up to ``GROUP / MERGE`` pieces or one bin; they are packed in the next round, together
with those of ``MERGE`` groups, until one group is left. The other bins stay as they are:
what found no complement among so many random pieces is not likely to find one among
more. So no group grows, also where lengths never combine: after the first round it has
at most ``MERGE`` times the larger of ``GROUP / MERGE`` and a bin's documents.

Defined cases: a null text is an empty one, whose ids are the end id alone; an empty
table gives an empty result; rows with the same id, and equal rows, are packed one by
one; null ids stay null; further columns are ignored.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowrisk.session import written

# Words and word parts of which a worker remembers the ids; results don't depend on it.
CACHE = 400_000
GROUP = 3_000   # pieces packed together, about
MERGE = 10      # groups whose poorly filled bins are packed together next
FULL = 0.995    # share of any capacity from which a bin stays as it is
STRIDE = 10_000_000   # sequence numbers set aside for a group
LATIN_FROM, LATIN_TO = 0x80, 0xC3  # the largest byte of a word with letters up to U+00FF in UTF-8
_SIGNS = string.punctuation.replace("'", "").encode()  # an apostrophe may begin a token with letters


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. The defaults of documents and attention never bind."""

    tokens: int = 4096
    documents: int = 4096
    attention: float = 4096.0 ** 2
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"  # or "dot"


class _Recent:
    """A map that forgets what was not used while ``CACHE`` newer entries came."""

    def __init__(self):
        self.new, self.old = {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        self.new[key] = value


class _WordIds:
    """Ids of words, as little-endian 32-bit bytes.

    The tokenizer drops white space and never merges across it, nor across the border of
    letters and other signs, and it folds case: so a word of Latin letters (up to U+00FF, where
    case and composition have no special cases), with or without signs after it, is looked up
    in lower case and without the signs.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.plain = _Recent(), _Recent()

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word, encoded as one text: a call costs more than a word."""
        out = []
        for at in range(0, len(words), 2_000):
            part = words[at:at + 2_000]
            first = np.cumsum([0, *[len(w) + 1 for w in part]])[:-1]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            of = np.searchsorted(first, [o[0] for o in encoded.offsets], "right") - 1
            ends = np.searchsorted(of, np.arange(len(part)), "right")
            out += [ids[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
        return out

    def learn(self, words: set[bytes]) -> None:
        """Make the ids of all ``words`` known, new ones in one go."""
        missing = words.difference(self.words.new)
        again, put, parts = self.words.old, self.words.put, {}
        for w in missing:
            ids = again.get(w)
            if ids is None:
                parts[w] = _plain(w)
            else:
                put(w, ids)
        plain = {p: self.plain.get(p) for p in set(chain.from_iterable(parts.values()))}
        new = [p for p, ids in plain.items() if ids is None]
        for p, ids in zip(new, self._encoded([p.decode() for p in new])):
            plain[p] = ids
            self.plain.put(p, ids)
        for w, ps in parts.items():
            put(w, plain[ps[0]] if len(ps) == 1 else plain[ps[0]] + plain[ps[1]])

    def of(self, words: list[bytes]) -> bytes:
        known = self.words.new
        try:
            return b"".join([known[w] for w in words])
        except KeyError:  # the map turned over while it learned
            return b"".join([self._one(w) for w in words])

    def _one(self, word: bytes) -> bytes:
        ids = self.words.new.get(word)
        ids = self.words.old.get(word) if ids is None else ids
        return b"".join(self._encoded([p.decode() for p in _plain(word)])) if ids is None else ids


def _plain(word: bytes) -> tuple[bytes, ...]:
    """The parts of a word that the tokenizer encodes apart in any case: its letters in lower case, and signs behind them."""
    if word.isalpha():  # ASCII letters alone
        return (word.lower(),)
    stem = word.rstrip(_SIGNS)
    if stem.isalpha():
        low = stem.lower()
    elif stem and LATIN_FROM <= max(stem) <= LATIN_TO and (text := stem.decode()).isalpha():
        low = text.lower().encode()
    else:
        return (word,)
    return (low,) if len(stem) == len(word) else (low, word[len(stem):])


@lru_cache(maxsize=2)
def _word_ids(path: str) -> _WordIds:
    return _WordIds(path)


def _token_bytes(texts: list[str | None], known: _WordIds, end_id: int) -> Iterator[bytes]:
    """The ids of each text and the end id."""
    end = np.array([end_id], "<u4").tobytes()
    at = 0
    while at < len(texts):
        lists, held = [], 0
        while at < len(texts) and held < 100_000:  # words learned together
            lists.append((texts[at] or "").encode().split())  # bytes split at ASCII white space alone
            held += len(lists[-1])
            at += 1
        known.learn(set().union(*lists))
        for words in lists:
            yield known.of(words) + end


def tokenized_pieces(docs: DataFrame, path: str, tokens: int = 4096, end_id: int = 1,
                     with_ids: bool = False) -> DataFrame:
    """Per piece of a document: doc_id, piece, start, length, ids_crc32 and, if wanted, ids.

    ``path`` is the file of a public tokenizer that drops white space. Only documents
    longer than ``tokens`` are cut, into pieces of that length and a last one.
    """
    fields = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    fields += ", ids array<bigint>" if with_ids else ""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _word_ids(path)
        for batch in batches:
            rows, texts = [], [t if isinstance(t, str) else None for t in batch["text"]]
            for doc_id, ids in zip(batch["doc_id"].astype(object), _token_bytes(texts, known, end_id)):
                for k, at in enumerate(range(0, len(ids), 4 * tokens)):
                    part = ids[at:at + 4 * tokens]
                    row = [None if pd.isna(doc_id) else int(doc_id), k, at // 4, len(part) // 4, zlib.crc32(part)]
                    rows.append([*row, np.frombuffer(part, "<u4").astype(np.int64)] if with_ids else row)
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(cut, fields)


def best_fit(demands: np.ndarray, limits: np.ndarray, weights: Sequence[float], rule: str = "norm") -> np.ndarray:
    """Bin number of each row of ``demands``, already in the order in which they are placed."""
    share = demands / limits
    weights = np.asarray(weights, float)
    left = np.ones((max(16, len(share)), share.shape[1]))
    out, n = np.empty(len(share), np.int64), 0
    open_bins = np.empty(0, np.int64)
    smallest = np.minimum.accumulate(share[::-1], axis=0)[::-1] if len(share) else share
    for k, need in enumerate(share):
        if k % 256 == 0:  # bins too full for any piece still to come
            open_bins = open_bins[(left[open_bins] + 1e-12 >= smallest[k]).all(axis=1)]
        rest = left[open_bins]
        fits = np.flatnonzero((rest + 1e-12 >= need).all(axis=1))
        if len(fits):
            rest = rest[fits]
            score = rest @ (weights * need) if rule == "dot" else -(((rest - need) ** 2) @ weights)
            to = open_bins[fits[np.argmax(score)]]
        else:
            to, n = n, n + 1
            open_bins = np.append(open_bins, to)
        left[to] -= need
        out[k] = to
    return out


def _carried(fill: np.ndarray, pieces: np.ndarray, most: int) -> np.ndarray:
    """Which bins are packed anew: the worst filled, as long as they hold up to ``most`` pieces, one at least."""
    worst = np.argsort(fill, kind="stable")
    out = np.zeros(len(fill), bool)
    out[worst] = np.cumsum(pieces[worst]) <= most
    out[worst[:1]] = True
    return out & (fill < FULL)


def _pack(capacity: Capacity, last: bool, carry: int):
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], float)

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "_row"], ascending=[False, True, True, True], kind="stable",
                                na_position="last").reset_index(drop=True)
        length = rows["length"].to_numpy(float)
        demands = np.column_stack([length, np.ones(len(rows)), length ** 2])
        bins = best_fit(demands, limits, capacity.weights, capacity.rule)
        rows["sequence_id"] = rows["_group"].to_numpy() * STRIDE + bins
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        if not last:
            fill = np.max([np.bincount(bins, demands[:, k]) / limits[k] for k in range(3)], axis=0)
            rows.loc[_carried(fill, np.bincount(bins), carry)[bins], "sequence_id"] = -1
        return rows
    return group


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), group: int = GROUP, merge: int = MERGE) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    No piece may be longer than a sequence, or demand more attention than one has alone.
    """
    # Rows are numbered in the table, so equal rows and rows without an id are dealt to different groups.
    pieces = written(
        pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
        .withColumn("sequence_id", F.lit(-1).cast("long")).withColumn("offset", F.lit(0).cast("long"))
        .withColumn("_row", F.monotonically_increasing_id()),
        "pack-pieces")
    alone = F.col("length") >= FULL * capacity.tokens
    rest = pieces.filter(~alone)
    groups = max(1, -(-rest.count() // group))
    # A full piece is a sequence by itself, numbered below zero.
    done = pieces.filter(alone).withColumn("sequence_id", -F.col("_row") - 1).drop("_row")
    rows = rest.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    first_id = 0
    while True:
        packed = rows.groupBy("_group").applyInPandas(_pack(capacity, groups == 1, group // merge), rows.schema)
        packed = packed.withColumn("sequence_id", F.when(F.col("sequence_id") >= 0, F.col("sequence_id") + first_id)
                                   .otherwise(F.col("sequence_id")))
        if groups == 1:
            return done.unionByName(packed.drop("_group", "_row"))
        packed = written(packed, "pack-round")
        done = done.unionByName(packed.filter("sequence_id >= 0").drop("_group", "_row"))
        rows = packed.filter("sequence_id < 0").withColumn("_group", F.floor(F.col("_group") / merge).cast("long"))
        first_id += groups * STRIDE
        groups = -(-groups // merge)
