"""Benchmark decontamination: an FM-index per shard of the training texts.

Test items are cut into windows of ten words. A task turns its texts into shards of a few
million characters, as sequences of the test items' words; other words and the ends of
texts separate, and stretches too short for any window are left out. Each shard gets an
FM-index (`fm_index.py`): all windows are searched backwards at once through the ranks of a
wavelet matrix, occurrences are located by sampled suffix positions, and the words they
cover are merged to removal spans. A text lies in one shard, so its result is made where it
is read: nothing is shuffled, whatever is frequent in it.

Items are sent to the workers in slices of about ``SLICE_CHARS`` characters, so that memory
has a bound however large the test set is; each further slice is one more pass over the
texts, and the spans of a text are merged over the slices.

Defined cases: null texts have no words; items without words have no window; an item of
fewer words than a window is one window; items of equal ids are one item with the windows of
all its texts, and items without an id are one item whose id is written as empty; repeated
documents each get their result; an empty table of documents gives an empty result, one of
items leaves all documents clean; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowrisk.llm.fm_index import FMIndex
from flowrisk.session import written

WINDOW = 10
SHARD_CHARS = 4_000_000
SLICE_CHARS = 20_000_000

# Lower case for A-Z; all other ASCII characters but digits and letters end a word.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_BYTES_WORD = re.compile(rb"[^ ]+")
SEPARATOR = 1


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if isinstance(text, str) else []


@dataclass
class Windows:
    """The distinct windows of some items, and the items that have each of them."""

    symbols: dict[bytes, int]  # from 2 on
    patterns: np.ndarray
    lengths: np.ndarray
    items: list[str]
    of_window: np.ndarray      # items of window w: of_window[first[w]:first[w + 1]]
    first: np.ndarray

    @staticmethod
    def of(ids: list[str], texts: list[str | None], width: int = WINDOW) -> Windows:
        symbols: dict[bytes, int] = {}
        known = {i: k for k, i in enumerate(sorted(set(ids)))}
        owners: dict[tuple, set] = {}
        for i, text in zip(ids, texts):
            word = [symbols.setdefault(w, len(symbols) + 2) for w in words_of(text)]
            for at in range(max(len(word) - width + 1, min(len(word), 1))):
                owners.setdefault(tuple(word[at:at + width]), set()).add(known[i])
        patterns = np.zeros((len(owners), width), np.int64)
        for k, window in enumerate(owners):
            patterns[k, :len(window)] = window
        lists = [sorted(v) for v in owners.values()]
        return Windows(symbols, patterns, np.array([len(w) for w in owners], np.int64), list(known),
                       np.array([x for v in lists for x in v], np.int64),
                       np.concatenate([[0], np.cumsum([len(v) for v in lists])]).astype(np.int64))


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... ``count`` numbers for each."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


def _occurrences(codes: np.ndarray, first: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, word it begins at) of all occurrences in texts whose words start at ``first``."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(windows.lengths) or not len(codes):
        return none
    known = codes > SEPARATOR
    ends = np.zeros(len(codes) + 1, bool)
    ends[first] = True
    starts = np.flatnonzero(known & (ends[:-1] | ~np.concatenate([[False], known[:-1]])))
    stops = np.flatnonzero(known & (ends[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    long = stops - starts >= windows.lengths.min()
    starts, count = starts[long], (stops - starts)[long]
    if not len(starts):
        return none
    # The stretches one after the other, a separator behind each.
    word = _ranges(starts, count + 1)
    text = np.full(len(word), SEPARATOR, np.int64)
    inner = np.ones(len(word), bool)
    inner[np.cumsum(count + 1) - 1] = False
    text[inner] = codes[word[inner]]
    index = FMIndex(text, len(windows.symbols) + 2)
    low, high = index.search(windows.patterns, windows.lengths)
    window = np.repeat(np.arange(len(low)), high - low)
    return window, word[index.locate(_ranges(low, high - low))]


def _shard(rows: pd.DataFrame, words: list[list[bytes]], windows: Windows, with_text: bool) -> pd.DataFrame:
    n = len(rows)
    first = np.zeros(n + 1, np.int64)
    np.cumsum([len(w) for w in words], out=first[1:])
    codes = np.fromiter((c for w in words for c in map(windows.symbols.get, w, repeat(SEPARATOR))), np.int64, int(first[-1]))
    window, at = _occurrences(codes, first, windows)
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + windows.lengths[window], -1)
    hit = np.cumsum(cover)[:-1] > 0
    # Spans: hit words side by side in one text.
    ends = np.zeros(len(codes) + 1, bool)
    ends[first] = True
    begin = np.flatnonzero(hit & (ends[:-1] | ~np.concatenate([[False], hit[:-1]])))
    end = np.flatnonzero(hit & (ends[1:] | ~np.concatenate([hit[1:], [False]]))) + 1
    of_text = lambda place: np.searchsorted(first, place, side="right") - 1
    owner = of_text(begin)
    cut = np.searchsorted(owner, np.arange(n + 1))
    pairs = pd.DataFrame({"d": of_text(at), "w": window}).drop_duplicates()
    w = pairs["w"].to_numpy()
    count = windows.first[w + 1] - windows.first[w]
    found = pd.DataFrame({"d": np.repeat(pairs["d"].to_numpy(), count),
                          "i": windows.of_window[_ranges(windows.first[w], count)]}).drop_duplicates().sort_values(["d", "i"])
    items_of = np.searchsorted(found["d"].to_numpy(), np.arange(n + 1))
    item = found["i"].to_numpy()
    out = rows.drop(columns="text").reset_index(drop=True)
    out["n_words"] = np.diff(first)
    out["starts"] = [(begin[cut[k]:cut[k + 1]] - first[k]) for k in range(n)]
    out["ends"] = [(end[cut[k]:cut[k + 1]] - first[k]) for k in range(n)]
    out["items"] = [[windows.items[i] for i in item[items_of[k]:items_of[k + 1]]] for k in range(n)]
    if with_text:
        out["kept_text"] = [_without(t, s, e) if len(s) else t for t, s, e in zip(rows["text"], out["starts"], out["ends"])]
    return out


def _without(text: str, starts: np.ndarray, ends: np.ndarray) -> str:
    """``text`` without its words [start, end) and what stands between them."""
    data = text.encode()
    places = [m.span() for m in _BYTES_WORD.finditer(data.translate(_PLAIN))]
    out, at = [], 0
    for s, e in zip(starts, ends):
        out.append(data[at:places[s][0]])
        at = places[e - 1][1]
    return b"".join([*out, data[at:]]).decode()


def _searched(docs: DataFrame, windows: Windows, with_text: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = shared.value
        for batch in batches:
            shard = np.cumsum(batch["text"].str.len().fillna(0).to_numpy(np.int64)) // SHARD_CHARS
            for _, rows in batch.groupby(shard, sort=False):
                yield _shard(rows, [words_of(t) for t in rows["text"]], windows, with_text)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    made = f"{kinds}, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"
    return docs.mapInPandas(search, made + ", kept_text string" * with_text)


def _merged(spans):
    """Sorted spans, those that touch or overlap made one."""
    start = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    step = lambda done, s: F.when((F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]), F.concat(
        F.slice(done, 1, F.size(done) - 1),
        F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))),
    )).otherwise(F.concat(done, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.filter(F.array(start), lambda _: F.lit(False)), step)


def contamination(docs: DataFrame, items: DataFrame, with_text: bool = False, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, spans of words to remove, and the items found, sorted as strings.

    ``with_text`` adds ``kept_text``, the text without the spans (for test sets of one slice).
    """
    kind = docs.schema["doc_id"].dataType
    # Ids as text: numbers beside nulls would become doubles in pandas.
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    asked = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").filter("text is not null")
    n_chars = asked.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n_slices = max(-(-n_chars // slice_chars), 1)
    spans = F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"))
    if n_slices == 1:
        few = asked.toArrow().to_pandas()
        found = _searched(docs, Windows.of(list(few["item_id"]), list(few["text"])), with_text)
        return found.withColumn("spans", spans).withColumn("doc_id", F.col("doc_id").cast(kind)).drop("starts", "ends")
    if with_text:
        raise ValueError("kept_text needs a test set of one slice")
    rows, parts = written(docs.withColumn("_row", F.monotonically_increasing_id()), "decontaminate"), None
    for s in range(n_slices):
        few = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_slices)) == s).toArrow().to_pandas()
        part = _searched(rows, Windows.of(list(few["item_id"]), list(few["text"])), False)
        parts = part if parts is None else parts.unionByName(part)
    # One row per text and slice.
    whole = parts.withColumn("spans", spans).groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.flatten(F.collect_list("items"))).alias("items"))
    return whole.select(F.col("doc_id").cast(kind).alias("doc_id"), "n_words", _merged(F.col("spans")).alias("spans"), "items")
