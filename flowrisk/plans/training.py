"""Training runs: cross-validation, the production model and the numeric baseline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowrisk.operators import splits
from flowrisk.operators.clean import clean_baseline, clean_flows, find_target, first_rows
from flowrisk.operators.evaluate import classification_report, fold_f1_summary
from flowrisk.operators.explore import distribution, drop_rare_classes, label_encode
from flowrisk.plans.model import BASELINE, CACHED_IDS, FlowModel, ForestParams
from flowrisk.session import written
from flowrisk.sources.csv_files import read_csv_folder
from flowrisk.sources.sinks import export_predictions

# A class needs this many rows to be learned and evaluated.
LEAST_CLASS_ROWS = 50


def cross_validate(df: DataFrame, label: str, id_col: str, k: int = 5,
                   params: ForestParams = ForestParams(trees=100), exclude: Sequence[str] = ()) -> DataFrame:
    """Out-of-fold predictions of every labelled flow: ``id, fold, truth, predicted``."""
    folded = splits.stratified_folds(clean_flows(df, training=True, target=label, keep=(id_col, *exclude)),
                                     label, id_col, k, params.seed)
    folded = written(folded, "folds")  # every pass of every fold reads it
    left_out = list({id_col, "fold", *exclude})

    def predicted(fold: int) -> DataFrame:
        model = FlowModel.fit(folded.filter(F.col("fold") != fold), label,
                              replace(params, seed=params.seed + fold + 1), exclude=left_out)
        scored = model.with_probabilities(folded.filter(F.col("fold") == fold))
        return scored.select(id_col, "fold", F.col(label).alias("truth"), F.col("predicted_label").alias("predicted"))

    # Folds are fitted side by side as far as their rows and trees fit into the executors' memory.
    side_by_side = max(1, min(k, CACHED_IDS // max(1, folded.count() * params.trees)))
    with ThreadPool(side_by_side) as pool:
        parts = pool.map(inheritable_thread_target(folded.sparkSession)(predicted), range(k), chunksize=1)
    return written(reduce(DataFrame.unionByName, parts), "out-of-fold")  # each forest predicts once


@dataclass(frozen=True)
class TrainingRun:
    model: FlowModel
    distribution: DataFrame
    folds: DataFrame     # summary of the weighted F1 over folds
    report: DataFrame    # pooled classification report
    split: DataFrame     # input rows with a train/test split


def train(df: DataFrame, label: str, id_col: str, params: ForestParams = ForestParams(),
          k: int = 5, cv_trees: int = 100, exclude: Sequence[str] = ()) -> TrainingRun:
    """Distribution, cross-validation, 80/20 split and the final model on all rows."""
    predictions = cross_validate(df, label, id_col, k, replace(params, trees=cv_trees), exclude)
    return TrainingRun(
        model=FlowModel.fit(df, label, params, exclude=list({id_col, *exclude})),
        distribution=distribution(clean_flows(df, training=True, target=label), label),
        folds=fold_f1_summary(predictions, "fold", "truth", "predicted"),
        report=classification_report(predictions, "truth", "predicted"),
        split=splits.random_split(df, id_col, 0.8, params.seed),
    )


def training_metadata(spark: SparkSession, run: TrainingRun, version: str = "1") -> DataFrame:
    """One row describing a training run, to be exported as JSON."""
    info = run.model.model_info(spark, 15)
    folds = run.folds.select(
        "cv_folds", F.round("mean_f1_score", 4).alias("mean_f1_score"),
        F.round("std_f1_score", 4).alias("std_f1_score"))
    entries = F.sort_array(F.collect_list(F.struct("entry", "precision", "recall", "f1_score", "support")))
    report = run.report.agg(entries).scalar()  # a row per class and three averages
    return info.withColumns({
        "model_version": F.lit(version),
        "cross_validation": folds.select(F.struct("*")).scalar(),
        "classification_report": report,
    })


def score_files(model: FlowModel, folder: str, out: str, limit: int | None = None,
                order: Sequence[str] = (), fmt: str = "csv", where: Column | str | None = None) -> None:
    """Score the CSV files of a folder and export input and result columns.

    ``limit`` takes the first rows in ``order``; without it all rows are scored.
    """
    rows = read_csv_folder(SparkSession.active(), folder)
    if limit:
        rows = first_rows(rows, order, limit)
    export_predictions(model.score(rows, where=where), out, fmt)


def train_baseline(df: DataFrame, id_col: str, params: ForestParams = BASELINE,
                   sample: int | None = None) -> tuple[FlowModel, DataFrame]:
    """Numeric-only forest on three quarters of the rows; the model and the test predictions."""
    rows = clean_baseline(df, keep=(id_col,))
    label = find_target(rows)
    rows = drop_rare_classes(rows, label, LEAST_CLASS_ROWS)
    if sample is not None:
        rows = splits.sample_rows(rows, id_col, sample, params.seed)
    rows = splits.stratified_split(rows, label, id_col, 0.75, params.seed)
    model = FlowModel.fit(rows.filter(F.col("split") == "train"), label, params, categorical=(),
                          exclude=[id_col, "split"], derive=False)
    tested = model.with_probabilities(rows.filter(F.col("split") == "test"))
    return model, tested.select(id_col, F.col(label).alias("truth"), F.col("predicted_label").alias("predicted"))


def train_encoded(df: DataFrame, id_col: str, label: str, texts: Sequence[str],
                  features: Sequence[str], params: ForestParams = BASELINE) -> tuple[FlowModel, DataFrame]:
    """Forest over label-encoded text columns and numbers on 80 % of the rows."""
    for c in texts:
        df = label_encode(df, c, f"{c}_code")
    names = [f"{c}_code" if c in texts else c for c in features]
    rows = splits.random_split(df.select(id_col, *names, label), id_col, 0.8, params.seed)
    model = FlowModel.fit(rows.filter(F.col("split") == "train"), label, params, categorical=(),
                          exclude=[id_col, "split"], derive=False)
    tested = model.with_probabilities(rows.filter(F.col("split") == "test"))
    return model, tested.select(id_col, F.col(label).alias("truth"), F.col("predicted_label").alias("predicted"))
