"""Hard negatives by threshold joins over an inverted index (the L2AP scheme).

Vectors become whole numbers, floor(256 x). The anchors are a stated query set that is sent
to all rows in blocks; the rows of a task are its shard. For a threshold t the shard's
inverted index leaves out the first dimensions of a row for as long as the norms of the
row and of the queries up to there cannot make t. The products of the indexed dimensions
are accumulated a few dimensions at a time; after each step rows whose remaining norms
cannot lift any query to t go. What is left gets the omitted dimensions and is exact.

A search has windows, intervals of scores of which the first ``k`` rows are wanted. It
starts near a window's upper end and lowers the threshold until the window is full or its
lower end is reached; once full, the k-th score is the threshold for further rows. Tasks
send at most ``k`` rows a window, and Spark ranks those. First the anchors' positives are
found like this, in windows without ends, then the negatives between 80% and 100% of the
score of each positive.

At scale a pass over the vectors serves ``ANCHORS`` anchors, so the passes grow with their
number, and nothing is keyed by label or row: a frequent label does not gather in one task.

Defined cases: rows without an id, a label or a vector, or with a null or non-finite
component, take no part; equal rows and rows with equal ids count once, with the best of
their scores that fits, and the smallest of the vectors is the anchor; a shorter vector has
zeros for what it lacks; products that doubles cannot hold are computed in whole numbers of
any size, then rounded to a double and held to 64 bits; an empty table gives an empty result; further
columns are ignored. A negative score of a positive leaves its window empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

ANCHORS = 65_536   # anchors sent to the workers at a time, and so the rows the driver holds
ROWS, QUERIES = 4096, 64   # rows and queries that are multiplied together
STEP = 8           # dimensions accumulated between two cuts
EXACT = 2.0 ** 53  # whole numbers a double holds
LIMIT = 2 ** 63 - 1
LEVELS = (0.9, 0.6, 0.3, 0.0)  # thresholds between a window's lower and upper end, in turns
SLACK = 1 - 1e-9   # bounds are computed in doubles; a pair is cut only clearly below
K = 5


def whole(vectors, width: int | None = None) -> np.ndarray:
    """Rows of floor(256 x), padded with zeros to the longest or to ``width``."""
    rows = [np.floor(np.clip(np.asarray(v, np.float64) * 256.0, -1e300, 1e300)) for v in vectors]
    width = max([len(r) for r in rows], default=0) if width is None else width
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    """Norms of the first 0, 1, ... dimensions of each row."""
    return np.sqrt(np.concatenate([np.zeros((len(x), 1)), np.cumsum(x * x, axis=1)], axis=1))


class Shard:
    """Rows whose dimensions are ordered by weight, light ones first, for threshold joins."""

    def __init__(self, x: np.ndarray):
        self.order = np.argsort((x * x).sum(axis=0), kind="stable")
        self.x = x[:, self.order]
        self.before = _norms(self.x)
        self.after = _norms(self.x[:, ::-1])[:, ::-1]  # norms from a dimension on

    def above(self, q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (row of ``q``, row, product) whose product is at least ``t`` of the query."""
        q, dims = q[:, self.order], self.x.shape[1]
        before, after = _norms(q), _norms(q[:, ::-1])[:, ::-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(t[:, None] > 0, before / t[:, None], np.inf).max(axis=0)
            # Dimensions of a row that cannot make the threshold alone stay out of the index.
            omitted = ((self.before[:, 1:] * reach[1:]) < SLACK).sum(axis=1)
        start = omitted // STEP * STEP
        rows = np.flatnonzero(omitted < dims) if dims else np.arange(len(self.x))
        rows = rows[np.argsort(start[rows], kind="stable")]
        made = np.zeros((len(q), len(rows)))
        for low in range(0, dims, STEP):
            high = min(low + STEP, dims)
            listed = int(np.searchsorted(start[rows], low, side="right"))  # rows whose lists have begun
            if not listed:
                continue
            made[:, :listed] += q[:, low:high] @ self.x[rows[:listed], low:high].T
            if high < dims:
                head = rows[:listed]
                rest = after[:, high, None] * self.after[head, high] + before[:, start[head]] * self.before[head, start[head]]
                alive = np.ones(len(rows), bool)
                alive[:listed] = (made[:, :listed] + rest >= t[:, None] * np.where(t > 0, SLACK, 1 / SLACK)[:, None] - 1).any(axis=0)
                if not alive.all():
                    rows, made = rows[alive], made[:, alive]
        bound = before[:, start[rows]] * self.before[rows, start[rows]]
        i, j = np.nonzero(made + bound >= t[:, None] - 1 - 1e-9 * np.abs(t[:, None]))
        score, row = made[i, j], rows[j]
        for begin in np.unique(start[row]):
            if begin:
                some = np.flatnonzero(start[row] == begin)
                score[some] += np.einsum("ij,ij->i", q[i[some], :begin], self.x[row[some], :begin])
        fits = score >= t[i]
        return i[fits], row[fits], score[fits]


def _exactly(x: np.ndarray, q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``Shard.above`` for numbers that doubles don't hold: whole numbers of any size, held to 64 bits at last."""
    products = np.array([[int(v) for v in row] for row in q], object).reshape(q.shape) @ np.array([[int(v) for v in row] for row in x], object).reshape(x.shape).T
    products = np.clip(products, -LIMIT - 1, LIMIT).astype(np.float64)
    i, j = np.nonzero(products >= t[:, None])
    return i, j, products[i, j]


@dataclass
class Windows:
    """Wanted intervals of scores: ``low`` to ``high`` of a query, of rows with its label or with another."""

    query: np.ndarray   # place of the anchor
    low: np.ndarray
    high: np.ndarray
    same: bool


def _first(window, score, ids, k):
    """Places of the first ``k`` of each window, by score and then id; an id counts once."""
    order = np.lexsort((ids, -score, window))
    w, n = window[order], ids[order]
    again = pd.DataFrame({"w": w, "n": n}).duplicated().to_numpy()
    order, w = order[~again], w[~again]
    first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, np.int64)
    rank = np.arange(len(w)) - np.repeat(first, np.diff(np.append(first, len(w))))
    return order[rank < k]


class Search:
    """The best rows so far of each window, over the shards of a task."""

    def __init__(self, q: np.ndarray, labels: np.ndarray, ids: np.ndarray, windows: Windows, k: int = K):
        self.q, self.labels, self.ids, self.windows, self.k = q, labels, ids, windows, k
        self.least = windows.low.astype(np.float64).copy()  # what a further row must reach
        empty = np.zeros(0, np.int64)
        self.best = (empty, np.zeros(0), empty)  # window, score, row id
        bounds = np.searchsorted(windows.query, np.arange(len(q) + 1))
        self.of_query = bounds[:-1], bounds[1:]

    def add(self, x: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        width = max(x.shape[1], self.q.shape[1])
        x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, self.q))
        large = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1) >= EXACT
        shard = None if large else Shard(x)
        top = np.sqrt((x * x).sum(axis=1)).max(initial=0) if not large else np.inf
        for at in range(0, len(q), QUERIES):
            part = np.arange(at, min(at + QUERIES, len(q)))
            mine = np.arange(self.of_query[0][part[0]], self.of_query[1][part[-1]])  # windows of these queries
            if not len(mine):
                continue
            owner = self.windows.query[mine]
            peak = np.minimum(self.windows.high[mine], top * np.sqrt((q[owner] ** 2).sum(axis=1)) + 1) if not large else self.windows.high[mine]
            open_ = np.ones(len(mine), bool)
            for turn, level in enumerate(LEVELS):
                least = self.least[mine]
                with np.errstate(invalid="ignore"):
                    ends = np.where(np.isfinite(least), least, -np.abs(peak))
                    t = np.where(np.isfinite(peak), ends + (peak - ends) * level, least)
                t = least if turn == len(LEVELS) - 1 or large else np.maximum(t, least)
                lowest = np.full(len(q), np.inf)
                np.minimum.at(lowest, owner[open_], t[open_])
                wanted = part[np.isfinite(lowest[part]) | (lowest[part] == -np.inf)]
                if len(wanted):
                    i, row, score = _exactly(x, q[wanted], lowest[wanted]) if large else shard.above(q[wanted], lowest[wanted])
                    self._keep(wanted[i], row, score, mine[open_], labels, ids)
                # A window is done with the k-th row at the threshold or above it, or at its lower end.
                open_ &= (self.least[mine] < t) & (t > least)
                if not open_.any():
                    break

    def _keep(self, query, row, score, open_, labels, ids) -> None:
        """Merges the pairs found with the best of the windows that were open."""
        fits = (labels[row] == self.labels[query]) == self.windows.same
        fits &= ids[row] != self.ids[query]
        query, row, score = query[fits], row[fits], score[fits]
        is_open = np.zeros(len(self.windows.query), bool)
        is_open[open_] = True
        # Each pair is offered to all windows of its query.
        n = self.of_query[1][query] - self.of_query[0][query]
        pair = np.repeat(np.arange(len(query)), n)
        window = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.of_query[0][query], n)
        fits = is_open[window] & (score[pair] >= self.least[window]) & (score[pair] <= self.windows.high[window])
        window, pair = window[fits], pair[fits]
        if not len(window):
            return
        window, found, who = (np.concatenate([a, b]) for a, b in zip(self.best, (window, score[pair], ids[row[pair]])))
        keep = _first(window, found, who, self.k)
        self.best = window[keep], found[keep], who[keep]
        count = np.bincount(self.best[0], minlength=len(self.least))
        full = np.flatnonzero(count >= self.k)
        last = np.full(len(self.least), -np.inf)
        last[self.best[0]] = self.best[1]  # sorted by window and falling score: the last one stays
        self.least[full] = np.maximum(self.least[full], last[full])


def usable(vectors: DataFrame, modulus: int = 7, classes: int = 10) -> DataFrame:
    """vec_id, label and embedding of the rows that take part, labels of every ``modulus``-th id moved on by one."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % modulus == 0, (label + 1) % classes).otherwise(label)
    return vectors.filter(F.col("vec_id").isNotNull() & label.isNotNull() & x.isNotNull()).filter(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), x.cast("array<double>").alias("embedding"))


def _searched(rows: DataFrame, anchors: pd.DataFrame, windows: Windows, k: int) -> DataFrame:
    """(window, score, vec_id): of each window at most ``k`` rows per task."""
    shared = rows.sparkSession.sparkContext.broadcast((
        whole(anchors["embedding"]), anchors["label"].to_numpy(np.int64), anchors["vec_id"].to_numpy(np.int64), windows))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = Search(*shared.value, k)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at:at + ROWS]
                state.add(whole(part["embedding"]), part["label"].to_numpy(np.int64), part["vec_id"].to_numpy(np.int64))
        window, score, who = state.best
        # Doubles from 2 ** 63 on have no 64-bit number.
        whole_score = [min(max(int(s), -LIMIT - 1), LIMIT) for s in score]
        yield pd.DataFrame({"window": window, "score": np.array(whole_score, np.int64), "vec_id": who})

    found = rows.mapInPandas(search, "window bigint, score bigint, vec_id bigint")
    found = found.groupBy("window", "vec_id").agg(F.max("score").alias("score"))
    first = Window.partitionBy("window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = K, negatives: int = K,
                   least_percent: int = 80, block: int = ANCHORS) -> DataFrame:
    """For each anchor (an id divisible by ``every``) and positive the first hard negatives."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v"))
    asked = asked.select("vec_id", "v.label", "v.embedding")
    n_blocks = -(-asked.count() // block)
    found = []
    for b in range(n_blocks):
        anchors = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).toArrow().to_pandas()
        if anchors.empty:
            continue
        n = len(anchors)
        near = _searched(rows, anchors, Windows(np.arange(n), np.full(n, -np.inf), np.full(n, np.inf), True), positives).toArrow().to_pandas()
        if near.empty:
            continue
        near = near.sort_values(["window", "rank"], ignore_index=True)
        high = near["score"].to_numpy(np.int64)
        low = np.array([-(-least_percent * int(s) // 100) for s in high], np.float64)
        windows = Windows(near["window"].to_numpy(np.int64), low, high.astype(np.float64), False)
        pairs = pa.table({"window": np.arange(len(near)), "anchor_id": anchors["vec_id"].to_numpy()[near["window"]],
                          "positive_id": near["vec_id"].to_numpy(), "positive_score": high})
        pairs = F.broadcast(spark.createDataFrame(pairs))  # at most `block` anchors with `positives` rows each
        found.append(_searched(rows, anchors, windows, negatives).join(pairs, "window").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")))
    out = found[0] if found else spark.createDataFrame([], RESULT)
    for more in found[1:]:
        out = out.unionByName(more)
    return out
