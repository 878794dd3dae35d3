"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is taken floor(r) times, where r is the source's target
over its size, and once more with probability r - floor(r). The cube method moves
those probabilities to 0 or 1 inside the null space of two constraints, the expected
tokens and the expected documents of the source, so both totals hold during the whole
flight. The flight runs in blocks of a source; each block leaves at most two undecided
documents, which fly on together with those of other blocks until one block per source
is left. Only its last two documents are landed, so a source misses its target by about
one document however large it is.

Defined cases: null and empty texts have size 0 and are sampled like others; null
sources form one source, last in code point order; rows with the same id are separate
units; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from flowrisk.llm.common import n_words, with_table
from flowrisk.session import written

BLOCK = 1_000   # documents that fly together first, about
MERGE = 500     # blocks whose undecided documents fly together next


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                   limit: float = 2.0) -> DataFrame:
    """Per source: its size, its number of documents and its target.

    ``sizes`` has source and size. Sources in code point order, null last, take the
    ``weights`` in turn and divide ``share`` times all sizes among them. A target stops at
    ``limit`` times its source's size and the rest is shared by weight among the others,
    which is min(limit * size, level * weight) for one level: sources sorted by
    limit * size / weight fill up one after the other, and the level is that of the first
    that does not, which is the highest of those that fit. ``share`` must not exceed ``limit``.
    """
    if share > limit:
        raise ValueError("share must not exceed limit: no mix could reach it")
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(limit)
    everything = Window.partitionBy(F.lit(0))
    filling = everything.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        by_source.withColumn("_weight", weight)
        .withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything) * float(share))
        # Level if every source before this one is full and none from here on is.
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                    / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))))
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything))
    )
    return ranked.select("source", "source_size", "n_docs",
                         F.least("_cap", F.coalesce(F.col("_level"), F.lit(float("inf"))) * F.col("_weight")).alias("target"))


def _flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> None:
    """Move ``p`` in place along directions that keep sum(p) and sum(p * size).

    Three undecided units at a time have one such direction; each move decides one of
    them at least, so about two stay undecided.
    """
    order = rng.permutation(np.flatnonzero((p > 0) & (p < 1))).tolist()
    chance = rng.random(len(order)).tolist()
    q, s = p.tolist(), size.tolist()
    held: list[int] = []
    for step, i in enumerate(order):
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        move = [s[b] - s[c], s[c] - s[a], s[a] - s[b]]
        if not any(move):
            move = [1.0, -1.0, 0.0]
        up = down = float("inf")
        for k, u in zip(held, move):
            if u > 0:
                up, down = min(up, (1 - q[k]) / u), min(down, q[k] / u)
            elif u < 0:
                up, down = min(up, q[k] / -u), min(down, (1 - q[k]) / -u)
        far = up if chance[step] * (up + down) < down else -down
        for k, u in zip(held, move):
            q[k] = min(1.0, max(0.0, q[k] + far * u))
            if q[k] < 1e-9 or q[k] > 1 - 1e-9:
                q[k] = round(q[k])
        held = [k for k in held if 0 < q[k] < 1]
        if len(held) == 3:  # rounding left none at its end: decide the nearest
            k = min(held, key=lambda x: min(q[x], 1 - q[x]))
            q[k] = float(round(q[k]))
            held.remove(k)
    p[:] = q


def _land(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> None:
    """Decide the last units: the choice nearest the expected tokens, ties by chance."""
    last = np.flatnonzero((p > 0) & (p < 1))
    if not len(last):
        return
    wanted = float((p[last] * size[last]).sum())
    choices = (np.arange(2 ** len(last))[:, None] >> np.arange(len(last))) & 1
    off = np.abs(choices @ size[last] - wanted) + rng.random(len(choices)) * 1e-6
    p[last] = choices[np.argmin(off)]


def _fly(keep: bool, seed: int):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_order", "doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        rng = np.random.default_rng([seed, int(rows["_block"].iloc[0]), len(rows), int(rows["_order"].iloc[0]) & 0xFFFFFFFF])
        p, size = rows["_p"].to_numpy(float).copy(), rows["size"].to_numpy(float)
        _flight(p, size, rng)
        if not keep:
            _land(p, size, rng)
        rows["_p"] = p
        return rows
    return block


def mix_sources(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0,
                seed: int = 17, block: int = BLOCK, merge: int = MERGE) -> DataFrame:
    """``sizes`` (doc_id, source, size) with source_size, target and ``copies`` to take.

    Reruns over the same rows give the same copies: blocks, order and draws depend on ids
    and ``seed`` alone.
    """
    sizes = written(sizes.select("doc_id", "source", F.col("size").cast("long").alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, share, limit)
    largest = sizes.groupBy("source").count().agg(F.max("count")).collect()[0][0]
    rows = with_table(sizes, targets, ["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (
        rows.withColumn("_rate", F.least(rate, F.lit(float(limit))))
        .withColumn("_base", F.floor("_rate").cast("long"))
        .withColumn("_p", F.col("_rate") - F.col("_base"))
        .withColumn("_order", F.xxhash64("doc_id", "size", F.lit(seed)))
        .withColumn("_block", F.pmod(F.col("_order"), F.ceil(F.col("n_docs") / block)))
        .drop("_rate", "n_docs")
    )
    blocks = -(-(largest or 0) // block)
    decided = None
    while True:
        flown = rows.groupBy("source", "_block").applyInPandas(_fly(blocks > 1, seed), rows.schema)
        if blocks <= 1:
            decided = flown if decided is None else decided.unionByName(flown)
            break
        flown = written(flown, "mix-flight")
        settled = (F.col("_p") <= 0) | (F.col("_p") >= 1)
        done = flown.filter(settled)
        decided = done if decided is None else decided.unionByName(done)
        rows = flown.filter(~settled).withColumn("_block", F.floor(F.col("_block") / merge).cast("long"))
        blocks = -(-blocks // merge)
    return decided.select("doc_id", "source", "size", "source_size", "target",
                          (F.col("_base") + F.round("_p").cast("long")).alias("copies"))


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
