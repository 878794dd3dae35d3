"""Substring deduplication by seed and extend.

Seeds: every ``SEED`` consecutive words have a hash; of the seeds inside each window of
``least`` words the smallest is an anchor. Two equal windows have the same anchor in the
same place, so joining documents on anchors finds every repeat of ``least`` words or
more, and anchors are about one word in eighteen.

Extension: from a shared anchor a repeat grows both ways. First all the way, to the
neighbourhood that holds every window around the anchor: if it also stands in a document
with a smaller id, it is a repeat as a whole. Occurrences that no smaller document
matches that far, where an anchor has several neighbourhoods, lie at the edge of a
repeat; they grow word by word, that is by the windows that contain the anchor, keyed by
a 128-bit hash. The smallest document that holds a window is always among them, for none
smaller has its neighbourhood. Overlapping matches of a document merge into maximal
repeats. Occurrences meet only as minima of their hash, with partial sums before the
shuffle and one row per key joined back: a passage in a third of all documents costs its
occurrences, never their pairs.

Defined cases: null and empty texts have no words; texts shorter than ``least`` keep all;
a null id counts as larger than any other; rows with equal ids never remove words from
one another, and each is judged by its own text; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowrisk.llm.common import with_table, words_of
from flowrisk.llm.rolling import Texts, hashed, text_mark, window_argmin
from flowrisk.session import written

SEED = 16
LEAST = 50
_PLACE = 40  # bits of a place in a text; the bits above mark the text


def _window_anchors(t: Texts, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows inside a text, the place of each one's anchor, and the seed hashes."""
    n = int(t.first[-1])
    if n < least:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.arange(n - SEED + 1)
    seeds = t.span(at, at + SEED)
    anchor = window_argmin(seeds, least - SEED + 1)
    end = np.repeat(t.first[1:], np.diff(t.first))
    start = np.flatnonzero(np.arange(n - least + 1) + least <= end[:n - least + 1])
    return start, anchor[start], seeds


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _marks(t: Texts) -> np.ndarray:
    return np.array([text_mark(x) for x in t.rows["text"]], np.int64) << _PLACE


def anchors(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Every anchor of every text: its hash, its neighbourhood's 128-bit hash, document and place."""
    reach = least - SEED

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in hashed(batches):
            _, anchor, seeds = _window_anchors(t, least)
            at = np.unique(anchor)
            doc = np.searchsorted(t.first, at, "right") - 1
            low, high = np.maximum(at - reach, t.first[doc]), np.minimum(at + SEED + reach, t.first[doc + 1])
            side = (at - low).astype(np.uint64)  # where in the neighbourhood the anchor stands
            yield pd.DataFrame({
                "anchor": _signed(seeds[at]),
                "n1": _signed(t.span(low, high) + side), "n2": _signed(t.span(low, high, 1) ^ side),
                "doc_id": t.rows["doc_id"].astype("Int64").array[doc],
                "at": _marks(t)[doc] + at - t.first[doc],
            })

    return docs.select("doc_id", "text").mapInPandas(find, "anchor bigint, n1 bigint, n2 bigint, doc_id bigint, at bigint")


def _edge_windows(docs: DataFrame, edges: DataFrame, least: int) -> DataFrame:
    """The windows whose anchor is one of ``edges`` (doc_id, places), with their 128-bit hashes."""
    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in hashed(batches):
            start, anchor, _ = _window_anchors(t, least)
            marks, wanted = _marks(t), np.zeros(int(t.first[-1]) + 1, bool)
            for d, places in enumerate(t.rows["places"]):
                places = np.asarray(places, np.int64)
                places = places[(places >> _PLACE) == (marks[d] >> _PLACE)]
                wanted[t.first[d] + (places & ((1 << _PLACE) - 1))] = True
            start = start[wanted[anchor]]
            doc = np.searchsorted(t.first, start, "right") - 1
            yield pd.DataFrame({
                "h1": _signed(t.span(start, start + least)), "h2": _signed(t.span(start, start + least, 1)),
                "doc_id": t.rows["doc_id"].astype("Int64").array[doc], "at": marks[doc] + start - t.first[doc],
            })

    rows = with_table(docs, edges, ["doc_id"])
    return rows.select("doc_id", "text", "places").mapInPandas(grow, "h1 bigint, h2 bigint, doc_id bigint, at bigint")


def _repeats(occurrences: DataFrame, key: list[str]) -> DataFrame:
    """``occurrences`` with ``later``: whether a document with a smaller id has the same key."""
    least = occurrences.groupBy(*key).agg(F.min("doc_id").alias("_least"))
    rows = with_table(occurrences, least, key)
    later = F.col("_least") < F.col("doc_id")
    return rows.withColumn("later", F.coalesce(later, F.col("doc_id").isNull() & F.col("_least").isNotNull()))


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per document with repeats: doc_id and places, the marked places of its matches.

    ``whole`` holds anchors whose neighbourhood is a repeat, ``windows`` starts of windows.
    """
    found = written(anchors(docs, least), "repeat-anchors")
    lowest, highest = F.min("doc_id"), F.max("doc_id")
    shared = (
        found.groupBy("anchor").agg(lowest.alias("_low"), highest.alias("_high"), F.count("doc_id").alias("_some"),
                                    F.count(F.lit(1)).alias("_all"))
        .filter((F.col("_low") < F.col("_high")) | ((F.col("_some") > 0) & (F.col("_all") > F.col("_some"))))
        .select("anchor")
    )
    # Written, as no later grouping may inherit the layout by anchor, which a hot one makes uneven.
    shared = written(found.join(shared, "anchor", "left_semi"), "repeat-shared")
    kinds = shared.groupBy("anchor").agg((F.min("n1") < F.max("n1")).alias("_several"))
    seen = written(
        with_table(_repeats(shared, ["anchor", "n1", "n2"]), kinds, ["anchor"])
        .filter(F.col("later") | F.col("_several")).select("doc_id", "at", "later"), "repeat-seeds")
    edges = seen.filter(~F.col("later")).groupBy("doc_id").agg(F.collect_list("at").alias("places"))
    grown = _repeats(_edge_windows(docs.select("doc_id", "text"), edges, least), ["h1", "h2"]).filter("later")
    matched = (
        seen.filter("later").select("doc_id", "at", F.lit(True).alias("whole"))
        .unionByName(grown.select("doc_id", "at", F.lit(False).alias("whole")))
    )
    return matched.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("whole"), F.col("at"))).alias("whole"),
        F.collect_list(F.when(~F.col("whole"), F.col("at"))).alias("windows"))


def _covered(n: int, mark: int, whole, windows, least: int) -> np.ndarray:
    """Which of a text's n words a repeat covers."""
    reach, step = least - SEED, np.zeros(n + 1, np.int64)
    for places, before, after in ((whole, reach, SEED + reach), (windows, 0, least)):
        if places is None or not len(places):
            continue
        places = np.asarray(places, np.int64)
        at = places[(places >> _PLACE) == (mark >> _PLACE)] & ((1 << _PLACE) - 1)
        low, high = np.maximum(at - before, 0), np.minimum(at + after, n)
        fits = high - low >= least
        np.add.at(step, low[fits], 1)
        np.add.at(step, high[fits], -1)
    return np.cumsum(step[:n]) > 0


def remove_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text and its maximal repeats.

    ``kept_text`` has the words that no repeat covers, joined by one space; ``repeats``
    the spans removed, as word places [start, stop).
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, whole, windows in zip(batch["doc_id"].astype("Int64"), batch["text"], batch["whole"], batch["windows"]):
                words = words_of(text) if isinstance(text, str) else []
                gone = _covered(len(words), text_mark(text) << _PLACE, whole, windows, least)
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                kept = words if not len(turns) else [w for w, g in zip(words, gone) if not g]
                out.append((doc_id, len(words), len(words) - len(kept), " ".join(kept),
                            [{"start": int(a), "stop": int(b)} for a, b in turns.reshape(-1, 2)]))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_text", "repeats"]).astype({"doc_id": "Int64"})

    texts = docs.select("doc_id", "text")
    rows = with_table(texts, repeats(docs, least), ["doc_id"], "left")
    return rows.select("doc_id", "text", "whole", "windows").mapInPandas(
        cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, repeats array<struct<start: bigint, stop: bigint>>")
