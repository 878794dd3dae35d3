"""The attack classifier: cleaning, features, preprocessing and a random forest as one model."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowrisk.functions import risk
from flowrisk.operators.clean import clean_flows, find_target, trim_names
from flowrisk.operators.explore import class_weights
from flowrisk.operators.features import derive_features
from flowrisk.operators.prep import FitStats, fit_stats
from flowrisk.plans.forest import Forest
from flowrisk.plans.scoring import RESULT_COLUMNS, add_risk, with_forecast
from flowrisk.schema import CATEGORICAL_COLUMNS
from flowrisk.sources.records import from_records


# Up to this many pairs of row and tree a fit's binned rows are kept in memory from pass to pass,
# and folds are fitted side by side; beyond it they lie on disk alone.
CACHED_IDS = 1_000_000_000
PART_ROWS = 500_000  # rows of a partition of training data


def spread(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in partitions for all cores, however few files it comes from.

    A forest's passes add up counts in every task, so there are no more partitions than cores
    and their size ask for.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-rows // (PART_ROWS * cores))))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` on the executors' disks while a fit reads it again and again."""
    df = df.persist(StorageLevel.DISK_ONLY)
    try:
        yield df
    finally:
        df.unpersist()


@dataclass(frozen=True)
class ForestParams:
    """Defaults of the production classifier; the baseline uses 100 trees of depth 20."""

    trees: int = 150
    depth: int = 25
    seed: int = 42
    max_bins: int = 64
    balanced: bool = True
    subsampling: float = 1.0
    # Memory for the histograms of one pass over the rows: more means fewer passes.
    memory_mb: int = 512

    def classifier(self, rows: int | None = None) -> Forest:
        """The learner; the number of ``rows``, if known, decides where it keeps them, not what it learns."""
        return Forest(
            featuresCol="features", labelCol="_y", weightCol="_w", numTrees=self.trees,
            maxDepth=self.depth, seed=self.seed, maxBins=self.max_bins, impurity="gini",
            minInstancesPerNode=1, featureSubsetStrategy="sqrt", maxMemoryInMB=self.memory_mb,
            subsamplingRate=self.subsampling, checkpointInterval=-1,
            cacheNodeIds=rows is not None and rows * self.trees <= CACHED_IDS,
        )


BASELINE = ForestParams(trees=100, depth=20)


@dataclass(frozen=True)
class FlowModel:
    """A fitted classifier. Scoring is one projection over the input, without a shuffle."""

    stats: FitStats
    forest: RandomForestClassificationModel
    classes: list[str]
    info: dict = field(default_factory=dict)
    derive: bool = True
    exclude: tuple[str, ...] = ()

    @staticmethod
    def fit(df: DataFrame, label: str = "label", params: ForestParams = ForestParams(),
            categorical: Sequence[str] = CATEGORICAL_COLUMNS, exclude: Sequence[str] = (),
            derive: bool = True) -> FlowModel:
        """Fit on labelled flows. ``exclude`` names columns such as keys to leave out."""
        df = clean_flows(df, training=True, target=label, keep=exclude)
        target = find_target(df, label)
        if target is None:
            raise ValueError(f"no {label!r} column among {df.columns}")
        # Medians, classes and the forest each read the rows several times.
        with kept(derive_features(df, derive).drop(*exclude)) as rows:
            stats = fit_stats(rows, categorical, (*exclude, target))
            # The forest holds a number per class in every leaf, so classes are few.
            weights = {r[target]: (r["n"], r["weight"]) for r in class_weights(rows, target).collect()}
            if not weights:
                raise ValueError("no labelled flow to fit on")
            classes = sorted(weights)
            index = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))])
            weight = F.create_map(*[
                F.lit(x) for c in classes for x in (c, weights[c][1] if params.balanced else 1.0)])
            # The metadata tells the learner the classes; without it a scan would count them.
            named = {"ml_attr": {"type": "nominal", "name": "_y", "vals": classes}}
            ready = stats.transform(rows).select(
                "features", index[F.col(target)].alias("_y", metadata=named), weight[F.col(target)].alias("_w"))
            n_samples = sum(n for n, _ in weights.values())
            with kept(spread(ready, n_samples)) as dealt:
                forest = params.classifier(n_samples).fit(dealt)
        info = {
            "model_type": "random forest",
            "classes": classes,
            "feature_count": len(stats.feature_names),
            "features": stats.feature_names,
            "trained_at": datetime.now(timezone.utc).isoformat(),
            "n_samples": n_samples,
            "input_schema": {f.name: f.dataType.simpleString() for f in df.schema
                             if f.name != target and f.name not in exclude},
        }
        return FlowModel(stats, forest, classes, info, derive, tuple(exclude))

    def with_probabilities(self, df: DataFrame, where: Column | str | None = None) -> DataFrame:
        """Input columns, ``p_<class>`` per class and ``predicted_label``.

        ``where`` is a condition on input columns (by trimmed names) that rows must meet;
        it is applied before the forest, so it reaches the scan.
        """
        df = trim_names(df)
        if where is not None:
            df = df.filter(where)
        # The input goes along untouched beside its cleaned copy.
        whole = df.withColumn("_input", F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in RESULT_COLUMNS]))
        rows = derive_features(clean_flows(whole, leaks=()), self.derive)
        scored = self.forest.transform(self.stats.transform(rows))
        # The forest is a function call the optimizer would copy into every filter on a
        # result column, once per use. A value that depends on the partition stays put;
        # filters on input columns go into ``where``.
        p = F.when(F.spark_partition_id() >= 0, vector_to_array("probability"))
        scored = scored.select("_input.*", p.alias("_p"))
        scored = scored.select("*", *[F.col("_p")[i].alias(f"p_{c}") for i, c in enumerate(self.classes)])
        label = risk.predicted_label({c: F.col(f"p_{c}") for c in self.classes})
        return scored.withColumn("predicted_label", label).drop("_p")

    def score(self, df: DataFrame, probabilities: bool = False, where: Column | str | None = None) -> DataFrame:
        """Input columns and the eight result columns; works on batches and streams."""
        scored = add_risk(self.with_probabilities(df, where), self.classes)
        return scored if probabilities else scored.drop(*[f"p_{c}" for c in self.classes])

    def score_records(self, spark: SparkSession, data: DataFrame | Mapping | list) -> DataFrame:
        return self.score(from_records(spark, data))

    def detect(self, df: DataFrame, keys: Sequence[str], order: Sequence[str],
               where: Column | str | None = None, **options) -> DataFrame:
        """Score, probability map and forecast after each flow of its key."""
        scored = self.score(df, probabilities=True, where=where)
        return with_forecast(scored, keys, order, self.classes, **options).drop(
            *[f"p_{c}" for c in self.classes])

    def importances(self, spark: SparkSession, n: int = 15) -> DataFrame:
        """The ``n`` most important features, importance rounded to four digits."""
        ranked = [(name, float(v)) for name, v in
                  zip(self.stats.feature_names, self.forest.featureImportances.toArray())]
        table = spark.createDataFrame(ranked, "feature string, importance double")
        return (
            table.orderBy(F.desc("importance"), "feature").limit(n)
            .withColumn("importance", F.round("importance", 4))
        )

    def model_info(self, spark: SparkSession, n: int = 10) -> DataFrame:
        """One row: description of the model, its classes and top features."""
        top = [(r["feature"], r["importance"]) for r in self.importances(spark, n).collect()]
        i = self.info
        return spark.createDataFrame(
            [(i["model_type"], self.classes, i["feature_count"], i["features"], i["trained_at"],
              i["n_samples"], i["input_schema"], top)],
            "model_type string, classes array<string>, feature_count int, features array<string>, "
            "trained_at string, n_samples bigint, input_schema map<string,string>, "
            "top_features array<struct<feature:string,importance:double>>",
        )

    def save(self, path: str) -> None:
        """Write forest and statistics under ``path``, a folder all executors share."""
        spark = SparkSession.active()
        self.forest.write().overwrite().save(f"{path}/forest")
        described = json.dumps({
            "stats": json.loads(self.stats.to_json()), "classes": self.classes, "info": self.info,
            "derive": self.derive, "exclude": list(self.exclude),
        })
        spark.createDataFrame([(described,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str, fallback: str | None = None) -> FlowModel:
        """Read a saved model; ``fallback`` is a parent folder to try when ``path`` has none."""
        try:
            text = spark.read.text(f"{path}/model").first()["value"]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            if fallback is None:
                raise FileNotFoundError(f"no model under {path}") from None
            return FlowModel.load(spark, f"{fallback.rstrip('/')}/{path}")
        raw = json.loads(text)
        return FlowModel(
            FitStats.from_json(json.dumps(raw["stats"])),
            RandomForestClassificationModel.load(f"{path}/forest"),
            raw["classes"], raw["info"], raw["derive"], tuple(raw["exclude"]),
        )
