"""Classification quality from truth and prediction columns.

Everything starts from one count per (fold,) truth and prediction, so the rows are
scanned once and only pairs of classes are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def pair_counts(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """The confusion matrix in long form: rows per (group,) truth and prediction."""
    return df.groupBy(*by, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str,
                     labels: Sequence[str] | None = None) -> DataFrame:
    """One row per true class, one column ``pred_<class>`` per class; all labels sorted."""
    pairs = pair_counts(df, truth, predicted)
    if labels is None:
        # The result has a column for each; `pair_counts` is the form for many.
        rows = pairs.select(F.explode(F.array("truth", "predicted")).alias("c")).distinct().collect()
        labels = sorted(r["c"] for r in rows if r["c"] is not None)
    cells = [
        F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).alias(f"pred_{c}")
        for c in labels
    ]
    every = df.sparkSession.createDataFrame([(c,) for c in labels], "truth string")
    table = every.join(pairs, "truth", "left")
    return table.groupBy("truth").agg(*cells)


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_scores(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of each class (and group)."""
    pairs = pair_counts(df, truth, predicted, by)
    # Each pair counts once for its truth and once for its prediction.
    sides = pairs.select(*by, "n", (F.col("truth") == F.col("predicted")).alias("hit"), F.explode(F.array(
        F.struct(F.col("truth").alias("class"), F.lit(True).alias("true_side")),
        F.struct(F.col("predicted").alias("class"), F.lit(False).alias("true_side")),
    )).alias("side")).select(*by, "n", "hit", "side.*")
    n, zero = F.col("n"), F.lit(0)
    totals = sides.groupBy(*by, "class").agg(
        F.sum(F.when(F.col("true_side") & F.col("hit"), n).otherwise(zero)).alias("tp"),
        F.sum(F.when(F.col("true_side"), n).otherwise(zero)).alias("support"),
        F.sum(F.when(~F.col("true_side"), n).otherwise(zero)).alias("predicted"),
    )
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    scored = totals.select(*by, "class", "tp", precision.alias("precision"),
                           recall.alias("recall"), "support")
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1_score", _ratio(2.0 * p * r, p + r))


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """A row per class, then accuracy, macro and weighted averages, as ``entry`` and scores.

    Accuracy stands in all three score columns of its row.
    """
    scores = class_scores(df, truth, predicted)
    columns = ["precision", "recall", "f1_score"]
    support = F.sum("support").alias("support")
    accuracy = _ratio(F.sum("tp"), F.sum("support"))
    averages = scores.agg(
        support,
        accuracy.alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in columns],
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}")
          for c in columns],
    )
    rows = [F.struct(F.lit("accuracy").alias("entry"), *[F.col("accuracy").alias(c) for c in columns])]
    for kind in ("macro", "weighted"):
        rows.append(F.struct(F.lit(f"{kind} avg").alias("entry"),
                             *[F.col(f"{kind}_{c}").alias(c) for c in columns]))
    summary = averages.select(F.explode(F.array(*rows)).alias("x"), "support").select("x.*", "support")
    return scores.select(F.col("class").alias("entry"), *columns, "support").unionByName(summary)


def fold_f1(df: DataFrame, fold: str, truth: str, predicted: str) -> DataFrame:
    """Weighted F1 of each fold."""
    scores = class_scores(df, truth, predicted, [fold])
    weighted = _ratio(F.sum(F.col("f1_score") * F.col("support")), F.sum("support"))
    return scores.groupBy(fold).agg(weighted.alias("weighted_f1"), F.sum("support").alias("support"))


def fold_f1_summary(df: DataFrame, fold: str, truth: str, predicted: str) -> DataFrame:
    """Folds, mean and population deviation of their weighted F1."""
    return fold_f1(df, fold, truth, predicted).agg(
        F.count(F.lit(1)).alias("cv_folds"),
        F.avg("weighted_f1").alias("mean_f1_score"),
        F.stddev_pop("weighted_f1").alias("std_f1_score"),
    )
