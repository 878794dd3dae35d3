"""A random forest grown over binned rows; it makes Spark's model of Spark's parameters.

The forest is that of Spark's learner: edges of bins from a weighted sample of the values, rows
drawn with Poisson counts for every tree, a random choice of features for every node, the split
of the greatest weighted gain in Gini impurity, and leaves of the same prediction merged. Spark
passes over every pair of row and tree once per level. Here a row leaves the passes when its leaf
is known, nodes of many rows are split by passes over all rows, and the rows of a node of at most
``NODE_ROWS`` rows go to one task, which grows what lies below it.

Counts are whole numbers and choices are hashes, so a forest depends neither on the order in
which tasks finish nor on how rows are passed. A task holds ``CHUNK_ROWS`` binned rows, the counts
of the nodes of one pass, or the rows of one group of small nodes.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from flowrisk.session import shared_path

CHUNK_ROWS = 131_072   # binned rows that a task works on at once
NODE_ROWS = 100_000    # drawn rows up to which one task grows a node to its leaves
BLOCK_CELLS = 1 << 21  # counts that are looked through for splits at once
NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
         "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
         "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")
_GROWN = "tree int, heap binary, feature binary, bin binary, gain binary, counts binary"


@dataclass(frozen=True)
class Rules:
    """What a task has to know to grow nodes."""

    seed: int
    features: int
    chosen: int            # features tried in a node
    bins: int
    weights: np.ndarray    # weight of a row of each class
    rate: float
    depth: int
    least_rows: int
    least_gain: float
    least_weight: float    # in a child

    @property
    def cells(self) -> int:
        """Counts of a node."""
        return self.chosen * self.bins * len(self.weights)

    @property
    def kind(self) -> type:
        return np.uint8 if self.bins <= 256 else np.uint16


def edges(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Bounds between at most ``bins`` bins of about equal weight, halfway between two values."""
    order = np.argsort(values, kind="stable")
    distinct, first = np.unique(values[order], return_index=True)
    weight = np.add.reduceat(weights[order], first) if len(first) else np.zeros(0)
    halfway = (distinct[:-1] + distinct[1:]) / 2
    if len(distinct) <= bins:
        return halfway
    stride = weight.sum() / bins
    made, so_far, target = [], weight[0], stride
    for i in range(1, len(distinct)):
        before, so_far = so_far, so_far + weight[i]
        if abs(before - target) < abs(so_far - target):
            made.append(halfway[i - 1])
            target += stride
    return np.array(made)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _choice(rules: Rules, tree: int, heap: np.ndarray) -> np.ndarray:
    """The features tried in each node, by hash."""
    if rules.chosen == rules.features:
        return np.broadcast_to(np.arange(rules.features), (len(heap), rules.features))
    start = _mixed(np.array([rules.seed % 2**64], "uint64") ^ _mixed(np.array([tree], "uint64")))
    keys = _mixed(_mixed(heap.astype("uint64") ^ start)[:, None] + np.arange(rules.features, dtype="uint64"))
    return np.sort(np.argsort(keys, axis=1, kind="stable")[:, :rules.chosen], axis=1)


def _poisson(rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the counts in 32 bits, and the count by the upper 16 where these decide it, else 255."""
    p, mass = [], math.exp(-rate)
    while len(p) < 200 and sum(p) < 1 - 1e-12:
        p.append(mass)
        mass *= rate / len(p)
    bounds = np.minimum(np.cumsum(p) * 2.0**32, 2.0**32).astype("uint64")
    upper = np.arange(65536, dtype="uint64") << np.uint64(16)
    low, high = (np.searchsorted(bounds, u, side="right") for u in (upper, upper + np.uint64(65535)))
    return bounds, np.where(low == high, low, 255).astype(np.uint8)


def _drawn(rules: Rules, table: tuple, part: int, chunk: int, tree: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a chunk that a tree draws, and how often."""
    bounds, counts = table
    random = np.random.Generator(np.random.SFC64([rules.seed % 2**64, part, chunk, tree])).integers(0, 2**32, n, np.uint32)
    c = counts.take(random >> np.uint32(16))
    open_ = np.flatnonzero(c == 255)
    c[open_] = np.searchsorted(bounds, random.take(open_).astype("uint64"), side="right")
    rows = np.flatnonzero(c != 0)
    return rows, c.take(rows)


def _counted(rules: Rules, x: np.ndarray, n: int, chosen: np.ndarray, rows: np.ndarray, slot: np.ndarray,
             y: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Drawn rows per slot, tried feature, bin and class. ``x`` holds a feature's n rows after another's."""
    classes = len(rules.weights)
    base, out = slot * rules.cells + y, np.zeros(len(chosen) * rules.cells)
    at = chosen * n
    for j in range(rules.chosen):
        cell = x.take(at[:, j].take(slot) + rows).astype(np.int64)
        cell *= classes
        cell += base
        cell += j * rules.bins * classes
        out += np.bincount(cell, c, len(out))
    return out


def _best(rules: Rules, counts: np.ndarray, chosen: np.ndarray) -> dict[str, np.ndarray]:
    """The best split of each node; ``feature`` is -1 where none gains."""
    shape = (-1, rules.chosen, rules.bins, len(rules.weights))
    left = counts.reshape(shape).cumsum(axis=2)
    total = left[:, 0, -1]
    left = left[:, :, :-1]
    right = total[:, None, None] - left

    def weighed(n):
        w = n * rules.weights
        whole = w.sum(-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return whole, whole - (w * w).sum(-1) / whole  # impurity times weight

    (all_w, all_i), (left_w, left_i), (right_w, right_i) = weighed(total), weighed(left), weighed(right)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (all_i[:, None, None] - left_i - right_i) / all_w[:, None, None]
    fits = (left.sum(-1) >= rules.least_rows) & (right.sum(-1) >= rules.least_rows)
    fits &= (left_w >= rules.least_weight) & (right_w >= rules.least_weight) & (gain >= rules.least_gain)
    gain = np.where(fits & (gain > 1e-15), gain, -1.0).reshape(len(total), -1)
    best, node = gain.argmax(axis=1), np.arange(len(total))
    j, b = np.divmod(best, rules.bins - 1)
    gain = gain[node, best]
    l = left[node, j, b]
    return {"feature": np.where(gain > 0, chosen[node, j], -1), "bin": b, "gain": gain,
            "left": l, "right": total - l, "counts": total}


def _open(rules: Rules, heap: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a node may be split further: classes differ and the depth is not reached."""
    return ((counts > 0).sum(-1) > 1) & (heap < 1 << rules.depth)


class _Nodes:
    """Finished nodes of a tree: number in the heap, split feature and bin or -1, gain, rows per class."""

    KINDS = {"heap": np.int64, "feature": np.int32, "bin": np.int32, "gain": np.float64, "counts": np.float64}

    def __init__(self):
        self.made = {k: [] for k in self.KINDS}

    def add(self, heap, counts, feature=None, bin=None, gain=None):
        none = np.full(len(heap), -1)
        for k, v in (("heap", heap), ("counts", counts), ("feature", none if feature is None else feature),
                     ("bin", none if bin is None else bin), ("gain", none if gain is None else gain)):
            self.made[k].append(v)

    def packed(self) -> list[bytes]:
        return [np.concatenate([np.asarray(v, kind).reshape(-1) for v in self.made[k]] or [np.zeros(0, kind)]).tobytes()
                for k, kind in self.KINDS.items()]


def _split(rules: Rules, nodes: _Nodes, heap: np.ndarray, found: dict) -> tuple[np.ndarray, ...]:
    """Record split nodes, leaves and finished children; the children as (heap, counts, open), left before right."""
    cut = (found["feature"] >= 0) & (heap < 1 << rules.depth)
    nodes.add(heap[cut], found["counts"][cut], found["feature"][cut], found["bin"][cut], found["gain"][cut])
    nodes.add(heap[~cut], found["counts"][~cut])
    child = (2 * heap[:, None] + np.arange(2)).reshape(-1)
    counts = np.stack([found["left"], found["right"]], axis=1).reshape(len(child), -1)
    open_ = np.repeat(cut, 2)
    there = open_.copy()
    open_ &= _open(rules, child, counts)
    nodes.add(child[there & ~open_], counts[there & ~open_])
    return child, counts, open_


def _grow(rules: Rules, tree: int, heap: np.ndarray, x: np.ndarray, slot: np.ndarray, y: np.ndarray,
          c: np.ndarray, nodes: _Nodes) -> None:
    """Grow the nodes ``heap`` to their leaves; row i lies in node ``slot[i]``."""
    n, rows = len(y), np.arange(len(y))
    x = x.reshape(-1)
    block = max(1, BLOCK_CELLS // rules.cells)
    while len(heap):
        chosen, found = _choice(rules, tree, heap), []
        if len(heap) > block:
            order = np.argsort(slot, kind="stable")
            rows, slot = rows[order], slot[order]
        for start in range(0, len(heap), block):
            some = slice(start, start + block)
            of = slice(None) if len(heap) <= block else slice(*np.searchsorted(slot, [start, start + block]))
            counts = _counted(rules, x, n, chosen[some], rows[of], slot[of] - start, y[rows[of]], c[rows[of]])
            found.append(_best(rules, counts, chosen[some]))
        found = {k: np.concatenate([f[k] for f in found]) for k in found[0]}
        child, _, open_ = _split(rules, nodes, heap, found)
        went = x[found["feature"][slot] * n + rows] > found["bin"][slot]
        code = np.where(open_, np.cumsum(open_) - 1, -1)[2 * slot + went]
        on = code >= 0
        rows, slot, heap = rows[on], code[on], child[open_]


def _chunks(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[tuple]:
    for batch in batches:
        for part, chunk, x, y in zip(*[batch.column(c) for c in ("part", "chunk", "x", "y")]):
            y = np.frombuffer(y.as_buffer(), np.int32)
            yield part.as_py(), chunk.as_py(), np.frombuffer(x.as_buffer(), rules.kind), y.astype(np.int64)


def _walk(x: np.ndarray, n: int, rows: np.ndarray, c: np.ndarray, path: list[tuple]) -> Iterator[tuple]:
    """Drawn rows from the root down ``path``; rows of small nodes as (rows, counts, number), last the open ones."""
    slot = np.zeros(len(rows), np.int64)
    for feature, bin_, code in path:
        if feature is None:  # the root itself
            to = np.full(len(rows), code[0])
        else:
            right = x.take((feature * n).take(slot) + rows) > bin_.astype(x.dtype).take(slot)
            slot *= 2
            slot += right
            to = code.take(slot)
        if code.min() < -1:
            small = np.flatnonzero(to < -1)
            yield rows.take(small), c.take(small), -2 - to.take(small)
        if code.min() < 0:
            on = np.flatnonzero(to >= 0)
            rows, c, to = rows.take(on), c.take(on), to.take(on)
        slot = to
    yield rows, c, slot


def _binned(rows: DataFrame, rules: Rules, bounds: list[np.ndarray]) -> DataFrame:
    """Chunks of rows: a feature's bins after another's, and classes."""
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])

    def bin_(batches):
        held, made, part = [], 0, None

        def chunk(some):
            x = np.concatenate([a for a, _ in some], axis=1)
            y = np.concatenate([b for _, b in some])
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, made, x.tobytes(), y.tobytes()), schema.types)],
                                              schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x = np.stack([np.searchsorted(b, values[:, i]).astype(rules.kind) for i, b in enumerate(bounds)])
            part = batch.column("part")[0].as_py()
            held.append((x, batch.column("y").to_numpy(zero_copy_only=False).astype(np.int32)))
            if sum(len(y) for _, y in held) >= CHUNK_ROWS:
                yield chunk(held)
                held, made = [], made + 1
        if held:
            yield chunk(held)

    return rows.withColumn("part", F.spark_partition_id()).mapInArrow(bin_, "part int, chunk int, x binary, y binary")


def _level(binned: DataFrame, rules: Rules, paths: dict[int, list], heaps: dict[int, np.ndarray]) -> dict[int, dict]:
    """The best splits of the open nodes of some trees, by one pass over all rows."""
    apart = max(1, (1 << 17) // (8 * rules.cells))  # nodes whose counts travel together
    table = _poisson(rules.rate)

    def count(batches):
        chosen = {t: _choice(rules, t, h) for t, h in heaps.items()}
        sums = {t: np.zeros(len(h) * rules.cells) for t, h in heaps.items()}
        for part, chunk, x, y in _chunks(batches, rules):
            for tree in heaps:
                for rows, c, slot in _walk(x, len(y), *_drawn(rules, table, part, chunk, tree, len(y)), paths[tree]):
                    pass
                if len(rows):
                    sums[tree] += _counted(rules, x, len(y), chosen[tree], rows, slot, y[rows], c)
        for tree, s in sums.items():
            for block in range(0, len(heaps[tree]), apart):
                some = s[block * rules.cells:(block + apart) * rules.cells]
                yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "block": pa.array([block], pa.int32()),
                                                  "counts": pa.array([some.tobytes()], pa.binary())})

    def split(table):
        tree, block = table["tree"][0].as_py(), table["block"][0].as_py()
        counts = sum(np.frombuffer(b.as_buffer()) for b in table["counts"])
        found = _best(rules, counts, _choice(rules, tree, heaps[tree][block:block + apart]))
        return pa.table({"tree": pa.array([tree], pa.int32()), "block": pa.array([block], pa.int32()), **{
            k: pa.array([found[k].astype(np.float64).tobytes()], pa.binary()) for k in _FOUND}})

    made = binned.mapInArrow(count, "tree int, block int, counts binary").groupBy("tree", "block").applyInArrow(
        split, "tree int, block int, " + ", ".join(f"{k} binary" for k in _FOUND))
    out: dict[int, list] = {}
    for r in made.orderBy("tree", "block").collect():
        out.setdefault(r["tree"], []).append({k: np.frombuffer(r[k]) for k in _FOUND})
    classes, found = len(rules.weights), {}
    for tree, blocks in out.items():
        joined = {k: np.concatenate([b[k] for b in blocks]) for k in _FOUND}
        found[tree] = joined | {k: joined[k].astype(np.int64) for k in ("feature", "bin")} | {
            k: joined[k].reshape(-1, classes) for k in ("left", "right", "counts")}
    return found


_FOUND = ("feature", "bin", "gain", "left", "right", "counts")


def _grown(binned: DataFrame, rules: Rules, paths: dict[int, list], small: dict[int, np.ndarray],
           groups: dict[int, np.ndarray]) -> DataFrame:
    """Small nodes grown to their leaves, each group of them in one task."""
    table = _poisson(rules.rate)
    names = ["tree", "group", "x", "root", "y", "c"]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    trees = [t for t in small if len(small[t])]

    def send(batches):
        for part, chunk, x, y in _chunks(batches, rules):
            n = len(y)
            by_feature, y = x.reshape(-1, n), y.astype(np.uint16)
            for tree in trees:
                *found, _ = _walk(x, n, *_drawn(rules, table, part, chunk, tree, n), paths[tree])
                if not found:
                    continue
                rows, c, number = (np.concatenate(v) for v in zip(*found))
                group = groups[tree][number]
                order = np.argsort(group.astype(np.uint16) if group.size and groups[tree][-1] < 65536 else group, kind="stable")
                rows, c, number, group = rows[order], c[order], number[order].astype(np.int32), group[order]
                starts = np.flatnonzero(np.diff(group, prepend=-1))
                for lo, hi in zip(starts, [*starts[1:], len(rows)]):
                    cells = (tree, group[lo], by_feature[:, rows[lo:hi]].tobytes(), number[lo:hi].tobytes(),
                             y[rows[lo:hi]].tobytes(), c[lo:hi].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(cells, kinds)], names)

    def grow(table):
        tree, group = table["tree"][0].as_py(), table["group"][0].as_py()
        read = lambda name, kind: [np.frombuffer(b.as_buffer(), kind) for b in table[name]]
        y = np.concatenate(read("y", np.uint16)).astype(np.int64)
        x = np.concatenate([b.reshape(rules.features, -1) for b in read("x", rules.kind)], axis=1)
        first, last = np.searchsorted(groups[tree], [group, group + 1])
        slot = np.concatenate(read("root", np.int32)).astype(np.int64) - first
        nodes = _Nodes()
        _grow(rules, tree, small[tree][first:last], x, slot, y, np.concatenate(read("c", np.uint8)), nodes)
        return pa.table([pa.array([tree], pa.int32()), *[pa.array([b], pa.binary()) for b in nodes.packed()]],
                        ["tree", *nodes.KINDS])

    sent = binned.mapInArrow(send, "tree int, group int, x binary, root binary, y binary, c binary")
    return sent.groupBy("tree", "group").applyInArrow(grow, _GROWN)


def _numbered(rules: Rules, bounds: list[np.ndarray], heap: np.ndarray, feature: np.ndarray, bin_: np.ndarray,
              gain: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes of a tree, numbered before their children and after their left siblings' children."""
    order = np.argsort(heap)
    heap, feature, bin_, gain, counts = heap[order], feature[order], bin_[order], gain[order], counts[order]
    w = counts * rules.weights
    prediction, whole = w.argmax(1), w.sum(1)
    left = np.searchsorted(heap, 2 * heap)  # heap numbers rise by level, a right child follows its left one
    size, level = np.ones(len(heap), np.int64), np.frexp(heap.astype(float))[1]
    for d in range(level.max(), 0, -1):
        at = np.flatnonzero((level == d) & (feature >= 0))
        a = left[at]
        # Sibling leaves of the same prediction become one leaf.
        same = (feature[a] < 0) & (feature[a + 1] < 0) & (prediction[a] == prediction[a + 1])
        feature[at[same]] = -1
        at, a = at[~same], a[~same]
        size[at] = 1 + size[a] + size[a + 1]
    number = np.full(len(heap), -1)
    number[0] = 0
    for d in range(1, level.max() + 1):
        at = np.flatnonzero((level == d) & (feature >= 0) & (number >= 0))
        number[left[at]] = number[at] + 1
        number[left[at] + 1] = number[at] + 1 + size[left[at]]
    there = number >= 0
    inner = feature >= 0
    last = np.minimum(left + 1, len(heap) - 1)
    bound = np.full(len(heap), 0.0)
    for f in np.unique(feature[inner]):
        bound[feature == f] = bounds[f][bin_[feature == f]]
    return {k: v[there] for k, v in {
        "id": number, "prediction": prediction.astype(float), "impurity": np.where(whole > 0, 1 - ((w / np.maximum(whole, 1e-300)[:, None]) ** 2).sum(1), 0.0),
        "stats": w, "rows": counts.sum(1).astype(np.int64), "gain": np.where(inner, gain, -1.0),
        "left": np.where(inner, number[np.minimum(left, len(heap) - 1)], -1), "right": np.where(inner, number[last], -1),
        "feature": feature, "bound": bound}.items()}


def _nodes(rules: Rules, bounds: list[np.ndarray]):
    """Function that makes the rows of Spark's stored model from the parts of a tree."""
    def assemble(table):
        tree, classes = table["tree"][0].as_py(), len(rules.weights)
        parts = [np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table[k]]) for k, kind in _Nodes.KINDS.items()]
        if not len(parts[0]):  # of few rows a tree may draw none
            parts = [np.array(v, kind) for v, kind in zip(([1], [-1], [-1], [-1], [0] * classes), _Nodes.KINDS.values())]
        v = _numbered(rules, bounds, *parts[:4], parts[4].reshape(-1, classes))
        n = len(v["id"])
        i32 = pa.int32()
        stats = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * classes, i32), pa.array(v["stats"].reshape(-1)))
        inner = v["feature"] >= 0
        bound = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(inner)]), i32), pa.array(v["bound"][inner]))
        split = pa.StructArray.from_arrays([pa.array(v["feature"], i32), bound, pa.array(np.full(n, -1), i32)],
                                           ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        node = pa.StructArray.from_arrays(
            [pa.array(v["id"], i32), pa.array(v["prediction"]), pa.array(v["impurity"]), stats, pa.array(v["rows"]),
             pa.array(v["gain"]), pa.array(v["left"], i32), pa.array(v["right"], i32), split],
            ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
        return pa.table([pa.array(np.full(n, tree), i32), node], ["treeID", "nodeData"])

    return assemble


class Forest(RandomForestClassifier):
    """Spark's learner with its own ``fit``. All rows of a class have the same weight, as class weights give.

    ``cacheNodeIds`` keeps the binned rows in memory as far as they fit, instead of on disk alone;
    a task holds counts of a quarter of ``maxMemoryInMB`` in a pass, or those of one tree.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        if self.getImpurity() != "gini" or not self.getBootstrap():
            raise ValueError("only Gini impurity and drawn rows are built")
        spark = dataset.sparkSession
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y"),
                              weight.alias("w"))
        seen = {r["y"]: r for r in rows.groupBy("y").agg(
            F.count(F.lit(1)).alias("n"), F.min("w").alias("w"), F.max("w").alias("most"),
            F.min(F.size("x")).alias("f"), F.max(F.size("x")).alias("most_f")).collect()}
        if not seen:
            raise ValueError("no row to fit on")
        if any(r["w"] != r["most"] for r in seen.values()):
            raise ValueError("rows of a class differ in weight")
        n, features = sum(r["n"] for r in seen.values()), max(r["most_f"] for r in seen.values())
        if features != min(r["f"] for r in seen.values()):
            raise ValueError("vectors differ in size")
        named = dataset.schema[self.getLabelCol()].metadata.get("ml_attr", {}).get("vals")
        classes = max(len(named or []), max(seen) + 1)
        weights = np.array([seen[i]["w"] if i in seen else 1.0 for i in range(classes)])
        bins = max(2, min(self.getMaxBins(), n))
        total = sum(r["n"] * r["w"] for r in seen.values())
        rules = Rules(
            seed=self.getSeed(), features=features, chosen=_tried(self.getFeatureSubsetStrategy(), features, self.getNumTrees()),
            bins=bins, weights=weights, rate=self.getSubsamplingRate(), depth=self.getMaxDepth(),
            least_rows=self.getMinInstancesPerNode(), least_gain=self.getMinInfoGain(),
            least_weight=self.getMinWeightFractionPerNode() * total)
        # Bins have edges from a sample, as in Spark; all rows are binned and learned from.
        share = min(1.0, max(self.getMaxBins() ** 2, 10_000) / n)
        some = (rows if share == 1 else rows.sample(False, share, rules.seed)).select("x", "w").toArrow()
        values = some["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, features)
        bounds = [edges(values[:, i], some["w"].to_numpy(), bins) for i in range(features)]
        level = StorageLevel.MEMORY_AND_DISK if self.getCacheNodeIds() else StorageLevel.DISK_ONLY
        binned = _binned(rows.drop("w"), rules, bounds).persist(level)
        try:
            path = shared_path(spark, "forest")
            self._write(binned, rules, bounds, n, path)
        finally:
            binned.unpersist()
        return self._copyValues(RandomForestClassificationModel.load(path))

    def _write(self, binned: DataFrame, rules: Rules, bounds: list[np.ndarray], n: int, path: str) -> None:
        spark, trees = binned.sparkSession, range(self.getNumTrees())
        passed = binned.coalesce(max(1, spark.sparkContext.defaultParallelism))
        nodes = {t: _Nodes() for t in trees}
        small: dict[int, list] = {t: [] for t in trees}      # heap numbers and rows of nodes for one task
        large = n * rules.rate > NODE_ROWS
        start = np.array([0 if large else -2])
        paths = {t: [(None, None, start)] for t in trees}
        heaps = {t: np.ones(1, np.int64) for t in trees if large}
        if not large:
            small = {t: [(1, n * rules.rate)] for t in trees}
        most = max(1, self.getMaxMemoryInMB() * 2**20 // 4 // (8 * rules.cells))  # nodes of a pass
        while heaps:
            found: dict[int, dict] = {}
            for some in _batched(heaps, most):
                found |= _level(passed, rules, paths, some)
            at, heaps = heaps, {}
            for tree, f in found.items():
                child, counts, open_ = _split(rules, nodes[tree], at[tree], f)
                large = open_ & (counts.sum(1) > NODE_ROWS)
                code = np.where(large, np.cumsum(large) - 1, -1)
                few = np.flatnonzero(open_ & ~large)
                code[few] = -2 - len(small[tree]) - np.arange(len(few))
                small[tree] += list(zip(child[few], counts[few].sum(1)))
                paths[tree].append((f["feature"], f["bin"], code))
                if large.any():
                    heaps[tree] = child[large]
        numbers = {t: np.array([h for h, _ in s], np.int64) for t, s in small.items()}
        groups = {t: (np.cumsum([m for _, m in s]) // NODE_ROWS).astype(np.int64) for t, s in small.items()}
        known = spark.createDataFrame([(t, *map(bytearray, nodes[t].packed())) for t in trees], _GROWN)
        made = known.unionByName(_grown(passed, rules, paths, numbers, groups)).groupBy("tree").applyInArrow(
            _nodes(rules, bounds), NODES)
        made.write.parquet(f"{path}/data")
        self._describe(spark, path, rules)

    def _describe(self, spark, path: str, rules: Rules) -> None:
        """The descriptions that Spark's reader expects beside the nodes."""
        own = ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")

        def text(kind, uid, without=(), **more):
            values = [{p.name: v for p, v in m.items() if p.name not in without} for m in (self._paramMap, self._defaultParamMap)]
            return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": int(time.time() * 1000),
                               "sparkVersion": spark.version, "uid": uid, "paramMap": values[0], "defaultParamMap": values[1], **more})

        size = {"numFeatures": rules.features, "numClasses": len(rules.weights)}
        forest = text("RandomForestClassificationModel", self.uid, **size, numTrees=self.getNumTrees())
        tree = [(t, text("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[-12:]}", own), 1.0) for t in range(self.getNumTrees())]
        spark.createDataFrame([(forest,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(tree, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")


def _tried(strategy: str, features: int, trees: int) -> int:
    """Features tried in a node, of Spark's names and numbers."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))),
             "onethird": math.ceil(features / 3)}
    if strategy in named:
        return named[strategy]
    number = float(strategy)
    return min(features, int(number) if number.is_integer() and "." not in strategy else math.ceil(number * features))


def _batched(heaps: dict[int, np.ndarray], most: int) -> Iterator[dict[int, np.ndarray]]:
    """Trees whose open nodes are counted in one pass; a tree of more nodes than that has a pass of its own."""
    held: dict[int, np.ndarray] = {}
    for tree, h in heaps.items():
        if held and sum(map(len, held.values())) + len(h) > most:
            yield held
            held = {}
        held[tree] = h
    if held:
        yield held
