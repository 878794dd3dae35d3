"""Near-duplicate vectors by randomised-rotation binary codes.

Vectors are brought to unit length and turned by random rotations; the signs of the
turned components are their binary codes. A code o of a vector v comes with its
correction factor f = <o, v>: the inner product of v with any unit vector q is estimated
without bias by <o, q> / f, with an error of sqrt((1 - f^2) / f^2 / (d - 1)) for a code
of d components, so the mean over ``ROTATIONS`` codes has a confidence bound of its own.
Only pairs whose bound reaches the threshold are computed exactly, in double precision.

Which pairs meet: bands of the sign bits are bucket keys. Bits agree with probability
1 - angle / pi, so the number of bands follows from their width and from the recall
wanted at the threshold itself; closer pairs are found almost surely. The width grows
with the logarithm of the number of distinct vectors, which keeps buckets small. Equal
vectors collapse before, with their number. Large buckets are cut into blocks, and pairs
of blocks are spread over tasks. A block pair gives each vector's number of links and a
spanning forest of them, never the pairs: its output grows with its vectors. A pair that
meets in several bands counts in the first one only.

Defined cases: vectors that are null, zero or hold null or non-finite components link
with nothing, and so do vectors of another length than most; null ids take part and
their rows keep null ids; rows with equal ids count as separate vectors of one component;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowrisk.llm.graph import components
from flowrisk.session import written

COSINE = 0.9
RECALL = 0.999
ROTATIONS = 2
CONFIDENCE = 4.5   # standard errors
BLOCK = 256
_SEED = 29


@lru_cache(maxsize=256)
def rotation(d: int, number: int) -> np.ndarray:
    """A random rotation of d dimensions, the same for the same number everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([_SEED, d, number]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def bands_for(rows: int, cosine: float, recall: float) -> tuple[int, int]:
    """Bits of a band and number of bands."""
    bits = max(8, min(32, math.ceil(math.log2(max(rows, 2))) - 1))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _signs(x: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """Key of every band, from the signs of as many rotations as that takes."""
    d = x.shape[1]
    turned = np.concatenate([x @ rotation(d, k) for k in range(-(-bits * bands // d))], axis=1)
    on = (turned[:, :bits * bands] >= 0).reshape(len(x), bands, bits)
    return (on @ (1 << np.arange(bits, dtype=np.int64))).astype(_key_type(bits))


def _key_type(bits: int) -> type:
    return np.uint16 if bits <= 16 else np.uint32


class Codes:
    """Binary codes of unit vectors in ``ROTATIONS`` rotations, with correction factors."""

    def __init__(self, x: np.ndarray):
        d = x.shape[1]
        self.turned, self.corrected, error = [], [], 0.0
        for k in range(ROTATIONS):
            turned = x @ rotation(d, k)
            code = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(d)
            factor = (code * turned).sum(axis=1)
            self.turned.append(turned)
            self.corrected.append(code / factor[:, None])
            error = error + (1 - factor ** 2) / factor ** 2 / max(d - 1, 1)
        self.error = np.sqrt(np.maximum(error, 0)) / ROTATIONS

    def estimate(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Unbiased estimates of <x[i], x[j]> from the codes of x[i]; ``error[i]`` is their standard error."""
        return sum(np.einsum("kd,kd->k", c[i], t[j]) for c, t in zip(self.corrected, self.turned)) / ROTATIONS


def _forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that hold the components of all ``pairs`` together."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def _usable(docs: DataFrame) -> DataFrame:
    """vec_id, ``v`` (the vector as doubles, null where it can't link) per row."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return docs.select("vec_id", F.when(fine, v).alias("v"))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _linked(rows: pd.DataFrame, d: int, kind: str, bits: int, bands: int, cosine: float) -> pd.DataFrame:
    """Links of whole block pairs: per vector their number, and pairs that hold them together."""
    n, group = len(rows), rows["group"].to_numpy()
    x = _unit(np.frombuffer(b"".join(rows["x"]), kind).reshape(n, d))
    keys = np.frombuffer(b"".join(rows["keys"]), _key_type(bits)).reshape(n, bands)
    codes, band, low = Codes(x), rows["band"].to_numpy(), rows["low"].to_numpy()
    cross = (rows["p"] != rows["q"]).to_numpy()
    copies, rep = rows["copies"].to_numpy(), rows["rep"].to_numpy()
    end = np.searchsorted(group, group, "right")
    links, pairs, apart, at = np.zeros(n, np.int64), [], 1, np.arange(n)
    while len(at := at[at + apart < end[at]]):
        i = at[~cross[at] | (low[at] != low[at + apart])]
        j = i + apart
        near = codes.estimate(i, j) + CONFIDENCE * codes.error[i] >= cosine
        i, j = i[near], j[near]
        exact = np.einsum("kd,kd->k", x[i], x[j]) >= cosine
        i, j = i[exact], j[exact]
        first = (keys[i] == keys[j]).argmax(axis=1) == band[i]  # they meet in no earlier band
        i, j = i[first], j[first]
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        pairs.append(np.column_stack([i, j]))
        apart += 1
    some = np.flatnonzero(links)
    forest = _forest(n, np.concatenate(pairs)) if pairs else []
    a, b = ([rep[k] for k in side] for side in (zip(*forest) if forest else ((), ())))
    return pd.DataFrame({
        "rep": np.concatenate([rep[some], np.array(a, np.int64)]),
        "links": np.concatenate([links[some], np.zeros(len(a), np.int64)]),
        "to": pd.array([None] * len(some) + list(b), "Int64")})


def _block_links(d: int, kind: str, bits: int, bands: int, cosine: float):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block pair; one that goes on in the next batch waits for it."""
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            which = rows[["band", "key", "p", "q"]]
            rows["group"] = (which != which.shift()).any(axis=1).cumsum()
            last = rows["group"].to_numpy() == rows["group"].iloc[-1] if len(rows) else np.zeros(0, bool)
            held = rows[last]
            if not last.all():
                yield _linked(rows[~last].reset_index(drop=True), d, kind, bits, bands, cosine)
        if held is not None and len(held):
            yield _linked(held.reset_index(drop=True), d, kind, bits, bands, cosine)
    return links


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id and kept."""
    rows = written(_usable(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = F.size("v")
    usual = rows.filter("v is not null").groupBy(size.alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not usual:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    d = usual[0]["d"]
    # Components travel as they came: narrowing to floats is exact where they were floats.
    kind = "f4" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "f8"
    mark = F.when(size == d, F.sha2(F.array_join("v", ","), 256))
    # One of each group of equal vectors stands for it.
    marked = written(rows.select("vec_id", "row", "v", mark.alias("mark")), "vector-marks")
    copies = marked.filter("mark is not null").groupBy("mark").agg(
        F.min("row").alias("rep"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    copies = written(copies, "vector-copies")
    bits, bands = bands_for(copies.count(), cosine, recall)

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["v"].to_numpy()).astype(kind)
            keys = _signs(_unit(x), bits, bands)
            yield pd.DataFrame({"rep": batch["rep"], "copies": batch["copies"], "x": [r.tobytes() for r in x],
                                "keys": [k.tobytes() for k in keys], "key": list(keys.astype(np.int64))})

    coded = (
        marked.join(copies, (marked["row"] == copies["rep"])).select("rep", "copies", "v")
        .mapInPandas(code, "rep bigint, copies bigint, x binary, keys binary, key array<bigint>")
    )
    coded = written(coded, "vector-codes")
    member = coded.select("rep", F.posexplode("key").alias("band", "key"))
    sizes = member.groupBy("band", "key").count().filter("count > 1")
    # A bucket of n vectors is cut into blocks; a vector goes to every pair its block is in.
    blocks = F.ceil(F.col("count") / block).cast("int")
    dealt = (
        member.join(sizes, ["band", "key"]).withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "band", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                (F.col("own") <= F.col("other")).alias("low"))
    )
    paired = (
        dealt.join(coded.select("rep", "copies", "x", "keys"), "rep")
        .repartition("band", "key", "p", "q").sortWithinPartitions("band", "key", "p", "q")
        .select("band", "key", "p", "q", "low", "rep", "copies", "x", "keys")
    )
    found = written(paired.mapInPandas(
        _block_links(d, kind, bits, bands, cosine), "rep bigint, links bigint, to bigint"), "vector-links")
    links = found.filter("to is null").groupBy("rep").agg(F.sum("links").alias("links"))
    names = copies.select("rep", "least")
    edges = components(found.filter("to is not null").select("rep", "to"), "rep", "to")
    least = (
        names.join(edges, F.col("rep") == F.col("node"), "left")
        .select("rep", F.coalesce("root", "rep").alias("root"), "least")
    )
    smallest = least.groupBy("root").agg(F.min("least").alias("component"))
    placed = least.join(smallest, "root").select("rep", "component")
    result = (
        marked.select("vec_id", "mark").join(copies.select(F.col("mark").alias("_mark"), "rep", "copies"),
                                             F.col("mark") == F.col("_mark"), "left")
        .join(links, "rep", "left").join(placed, "rep", "left")
    )
    component = F.when(F.col("rep").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return result.select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id").eqNullSafe(component), F.lit(False)).alias("kept"))
