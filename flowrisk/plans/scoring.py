"""Scoring: from class probabilities to detections, alerts and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowrisk.functions import risk
from flowrisk.functions.numeric import half_up
from flowrisk.operators.forecast import FORECAST_COLUMNS, forecast, observed_attack_prob
from flowrisk.operators.ordered import HOT_ROWS
from flowrisk.schema import BENIGN, CLASSES, TREND_WINDOW

RESULT_COLUMNS = [
    "predicted_label", "is_attack", "confidence", "attack_probability",
    "risk_score", "risk_level", "alert_triggered", "recommendation",
]


def class_columns(classes: Sequence[str]) -> dict[str, Column]:
    return {c: F.col(f"p_{c}") for c in classes}


def probability_map(classes: Sequence[str]) -> Column:
    items = [x for c in classes for x in (F.lit(c), half_up(F.col(f"p_{c}"), 4))]
    return F.create_map(*items)


def add_risk(df: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Risk columns from ``predicted_label`` and one ``p_<class>`` column per class.

    A plain projection: it works on a stream as well, and result columns replace
    input columns of the same name.
    """
    by_class = class_columns(classes)
    label = F.col("predicted_label")
    p_benign = by_class.get(BENIGN, F.lit(None).cast("double"))
    # Projections in steps: each value is computed once and the generated code stays
    # small enough for the JVM to compile.
    return (
        df.withColumn("_p_label", risk.probability_of(label, by_class))
        .withColumn("_attack", risk.attack_probability(label, p_benign, F.col("_p_label")))
        .withColumns({
            "confidence": risk.confidence(by_class),
            "attack_probability": half_up(F.col("_attack"), 4),
            "risk_score": risk.risk_score(label, p_benign, F.col("_p_label"), F.col("_attack")),
        })
        .withColumns(risk.verdict_columns(label, F.col("risk_score")))
        .drop("_p_label", "_attack")
    )


def add_risk_from_map(df: DataFrame, label: str = "predicted_label",
                      probabilities: str = "probabilities") -> DataFrame:
    """Risk columns from a label and a map of class probabilities with any keys."""
    p, name = F.col(probabilities), F.col(label)
    p_benign, p_label = F.col("_p_benign"), F.col("_p_label")
    return (
        df.withColumns({"_p_benign": F.try_element_at(p, F.lit(BENIGN)), "_p_label": F.try_element_at(p, name)})
        .withColumn("_attack", risk.attack_probability(name, p_benign, p_label))
        .withColumns({
            "confidence": half_up(F.array_max(F.map_values(p)), 4),
            "attack_probability": half_up(F.col("_attack"), 4),
            "risk_score": risk.risk_score(name, p_benign, p_label, F.col("_attack")),
            "probabilities": risk.rounded_probabilities(p),
        })
        .withColumns(risk.verdict_columns(name, F.col("risk_score")))
        .drop("_p_benign", "_p_label", "_attack")
    )


def with_forecast(scored: DataFrame, keys: Sequence[str], order: Sequence[str],
                  classes: Sequence[str] = CLASSES, window: int = TREND_WINDOW,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Scored flows with the probability map and the nested forecast after each of them."""
    benign = F.col(f"p_{BENIGN}") if BENIGN in classes else F.lit(None).cast("double")
    df = scored.withColumn("forecast_attack_prob", observed_attack_prob(benign))
    df = forecast(df, keys, order, window, hot_rows)
    return df.withColumns({
        "probabilities": probability_map(classes),
        "forecast": F.struct(*[F.col(c).alias(c.removeprefix("trend_")) for c in FORECAST_COLUMNS]),
    }).drop("forecast_attack_prob", *FORECAST_COLUMNS)
