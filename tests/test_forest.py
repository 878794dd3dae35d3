"""The learner of the forest against plain recursion, against itself over more tasks, and Spark's own."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowrisk.plans import forest as module
from flowrisk.plans.forest import Forest, Rules, edges
from flowrisk.plans.model import ForestParams


@pytest.fixture(scope="module")
def rows(spark):
    x = [((F.xxhash64("id", F.lit(i)) % 1000) / 10.0).alias(f"x{i}") for i in range(6)]
    noise = F.xxhash64("id", F.lit(99)) % 10 == 0
    y = F.when(noise, F.col("id") % 3).otherwise(F.when(F.col("x0") > 20, 2).when(F.col("x1") + F.col("x2") > 0, 1).otherwise(0))
    made = spark.range(0, 3000, 1, 3).select("id", *x).select(
        array_to_vector(F.array(*[f"x{i}" for i in range(6)])).alias("features"), y.cast("double").alias("_y"))
    weight = F.when(F.col("_y") == 0, 2.0).when(F.col("_y") == 1, 0.7).otherwise(1.0)
    return made.withColumn("_w", weight).persist()


def told(model):
    return model.toDebugString.split("\n", 1)[1]


def test_passes_and_tasks_grow_the_same_trees(rows, monkeypatch):
    few = ForestParams(trees=5, depth=9, max_bins=32).classifier()
    one_task = few.fit(rows)
    passes, level = [], module._level
    monkeypatch.setattr(module, "_level", lambda b, r, p, heaps: (passes.append(sum(map(len, heaps.values()))), level(b, r, p, heaps))[1])
    monkeypatch.setattr(module, "NODE_ROWS", 150)
    assert told(few.fit(rows)) == told(one_task)
    counted = sum(passes)
    assert passes[0] == 5
    passes.clear()
    monkeypatch.setattr(module, "NODE_ROWS", 0)  # passes alone, each over the counts of few nodes
    monkeypatch.setattr(module, "BLOCK_CELLS", 1)
    assert told(few.copy({few.maxMemoryInMB: 0}).fit(rows)) == told(one_task)
    assert sum(passes) > 3 * counted  # small nodes leave the passes


def test_nodes_are_split_best():
    random = np.random.default_rng(1)
    n, features, bins, weights = 400, 5, 8, np.array([1.0, 3.0, 0.5])
    x = random.integers(0, bins, (features, n)).astype(np.uint8)
    y, c = random.integers(0, 3, n), random.integers(1, 4, n).astype(np.uint8)
    rules = Rules(7, features, 2, bins, weights, 1.0, 5, 1, 0.0, 0.0)

    def impurity(rows):
        w = np.bincount(y[rows], c[rows], 3) * weights
        return w.sum(), 1 - ((w / w.sum()) ** 2).sum()

    def plain(heap, rows):
        whole, own = impurity(rows)
        found = (0.0, -1, -1)
        if len(set(y[rows])) > 1 and heap < 2**rules.depth:
            for f in module._choice(rules, 3, np.array([heap]))[0]:
                for b in range(bins - 1):
                    left, right = rows[x[f, rows] <= b], rows[x[f, rows] > b]
                    if len(left) and len(right):
                        gain = own - sum(w / whole * i for w, i in map(impurity, (left, right)))
                        if gain > found[0] + 1e-12:
                            found = gain, f, b
        gain, f, b = found
        below = {} if f < 0 else plain(2 * heap, rows[x[f, rows] <= b]) | plain(2 * heap + 1, rows[x[f, rows] > b])
        return {heap: (f, round(gain, 9), *np.bincount(y[rows], c[rows], 3))} | below

    nodes = module._Nodes()
    module._grow(rules, 3, np.array([1]), x, np.zeros(n, np.int64), y, c, nodes)
    made = {k: np.concatenate([np.asarray(v) for v in nodes.made[k]]) for k in nodes.KINDS}
    assert {h: (f, round(max(g, 0.0), 9), *n) for h, f, g, n in zip(*[made[k].tolist() for k in ("heap", "feature", "gain", "counts")])} == {
        h: tuple(v) for h, v in plain(1, np.arange(n)).items()}


def test_forest_is_like_that_of_spark(rows):
    few = ForestParams(trees=30, depth=6, max_bins=32)
    ours = few.classifier().fit(rows)
    sparks = RandomForestClassifier(featuresCol="features", labelCol="_y", weightCol="_w", numTrees=30, maxDepth=6, maxBins=32, seed=42).fit(rows)
    a, b = (np.array(m.featureImportances.toArray()) for m in (ours, sparks))
    assert np.abs(a - b).max() < 0.1
    right = [m.transform(rows).agg(F.avg((F.col("prediction") == F.col("_y")).cast("int"))).first()[0] for m in (ours, sparks)]
    assert abs(right[0] - right[1]) < 0.03
    assert 0.8 < ours.totalNumNodes / sparks.totalNumNodes < 1.25
    assert ours.getNumTrees == 30 and ours.numFeatures == 6 and ours.numClasses == 3


def test_draws_are_poisson():
    rules = Rules(7, 1, 1, 2, np.ones(2), 1.0, 5, 1, 0.0, 0.0)
    drawn = np.zeros(200_000)
    at, c = module._drawn(rules, module._poisson(1.0), 0, 0, 0, len(drawn))
    drawn[at] = c
    assert abs(drawn.mean() - 1) < 0.02 and abs(drawn.var() - 1) < 0.03
    assert abs((drawn == 0).mean() - np.exp(-1)) < 0.01 and 6 <= drawn.max() < 15


def test_edges_lie_between_values():
    assert edges(np.array([3.0, 1, 1, 2]), np.ones(4), 4).tolist() == [1.5, 2.5]
    assert edges(np.zeros(5), np.ones(5), 4).tolist() == []
    assert edges(np.arange(1000.0), np.ones(1000), 4).tolist() == [249.5, 499.5, 749.5]


def test_odd_tables(spark):
    def table(*rows):
        return spark.createDataFrame(list(rows), "x array<double>, _y double, _w double").select(
            array_to_vector("x").alias("features"), "_y", "_w")

    few = ForestParams(trees=6, depth=3, max_bins=8).classifier()
    one = table(([1.0, 2.0], 1.0, 1.0))
    assert few.fit(one).transform(one).count() == 1  # some trees draw no row
    assert few.fit(table(([1.0], 0.0, 1.0), ([1.0], 1.0, 1.0))).totalNumNodes == 6
    with pytest.raises(ValueError):
        few.fit(table(([1.0], 0.0, 1.0), ([2.0], 0.0, 2.0)))
    with pytest.raises(ValueError):
        few.fit(one.limit(0))
    assert isinstance(few, Forest)
