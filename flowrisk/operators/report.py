"""Summaries of scored flows: threats, key figures, posture, incidents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowrisk.functions.risk import risk_level
from flowrisk.schema import BENIGN


def threat_summary(scored: DataFrame) -> DataFrame:
    """Flows, threats and the attack's name: one class, ``multiple`` or none."""
    threat = F.col("predicted_label") != BENIGN
    names = F.when(threat, F.col("predicted_label"))
    summary = scored.agg(
        F.count(F.lit(1)).alias("flows"), F.count_if(threat).alias("threats"),
        F.min(names).alias("first_name"), F.max(names).alias("last_name"),
    )
    named = (
        F.when(F.col("threats") == 0, "none")
        .when(F.col("first_name") == F.col("last_name"), F.col("first_name"))
        .otherwise("multiple")
    )
    return summary.select("flows", "threats", named.alias("attack"))


def kpis(scored: DataFrame) -> DataFrame:
    """Flows, safe flows and threats per predicted class and, under ``all``, in total."""
    safe = F.col("predicted_label") == BENIGN
    rolled = scored.rollup("predicted_label").agg(
        F.grouping("predicted_label").alias("total"), F.count(F.lit(1)).alias("flows"),
        F.count_if(safe).alias("safe"), F.count_if(~safe).alias("threats"),
    )
    return rolled.select(
        F.when(F.col("total") == 1, "all").otherwise(F.col("predicted_label")).alias("predicted_label"),
        "flows", "safe", "threats",
        (100.0 * F.col("safe") / F.col("flows")).alias("safe_percent"),
        (100.0 * F.col("threats") / F.col("flows")).alias("threat_percent"),
    )


def posture(scored: DataFrame, by: Sequence = ()) -> DataFrame:
    """``severe`` as soon as a group holds an attack, else ``secure``."""
    attacked = F.max(F.col("predicted_label") != BENIGN)
    return scored.groupBy(*by).agg(
        F.when(attacked, "severe").otherwise("secure").alias("posture"),
        F.count_if(F.col("predicted_label") != BENIGN).alias("threats"),
        F.count(F.lit(1)).alias("flows"),
    )


def _bucket_verdict() -> list[Column]:
    return [risk_level(F.col("risk_score")).alias("risk_level"),
            F.when(F.col("threats") > 0, "Attack").otherwise(BENIGN).alias("predicted_label")]


def risk_by_time(scored: DataFrame, bucket: str, ts: str = "ts", keys: Sequence[str] = (), timed: bool = False) -> DataFrame:
    """Risk per key and time bucket: the observation of a bucket-wise forecast.

    The bucket counts as benign only if all its flows are. ``timed`` adds ``bucket_time``,
    the time by which a stream's next operator knows the bucket.
    """
    spans = scored.groupBy(*keys, F.window(ts, bucket).alias("span")).agg(
        F.count(F.lit(1)).alias("flows"),
        F.count_if(F.col("predicted_label") != BENIGN).alias("threats"),
        F.avg("forecast_attack_prob").alias("forecast_attack_prob"),
        F.avg("risk_score").alias("mean_risk"),
        F.max("risk_score").alias("risk_score"),
    )
    return spans.select(
        *keys, F.col("span.start").alias("bucket_start"), "flows", "threats",
        "forecast_attack_prob", "mean_risk", "risk_score", *_bucket_verdict(),
        *([F.window_time("span").alias("bucket_time")] if timed else []),
    )


def sliding_risk(scored: DataFrame, size: str, slide: str, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """Risk per key and overlapping time window of ``size``, one beginning every ``slide``.

    Flows are summed once, into panes of length ``slide``; windows merge the sums of their
    panes, so the cost per flow does not grow with the overlap. On a stream with a watermark
    on ``ts`` both steps keep state, and a window is final once the watermark has passed it.
    ``size`` must be a multiple of ``slide``.
    """
    panes = scored.groupBy(*keys, F.window(ts, slide).alias("pane")).agg(
        F.count(F.lit(1)).alias("flows"),
        F.count_if(F.col("predicted_label") != BENIGN).alias("threats"),
        F.count("forecast_attack_prob").alias("_probabilities"), F.sum("forecast_attack_prob").alias("_probability"),
        F.count("risk_score").alias("_risks"), F.sum("risk_score").alias("_risk"),
        F.max("risk_score").alias("risk_score"),
    )
    spans = panes.groupBy(*keys, F.window(F.window_time("pane"), size, slide).alias("span")).agg(
        F.sum("flows").alias("flows"), F.sum("threats").alias("threats"),
        (F.sum("_probability") / F.sum("_probabilities")).alias("forecast_attack_prob"),
        (F.sum("_risk") / F.sum("_risks")).alias("mean_risk"), F.max("risk_score").alias("risk_score"),
    )
    return spans.select(
        *keys, F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), "flows", "threats",
        "forecast_attack_prob", "mean_risk", "risk_score", *_bucket_verdict())


def latest_threats(scored: DataFrame, order: Sequence[str], n: int = 15) -> DataFrame:
    newest = [F.desc(c) for c in order]
    return scored.filter(F.col("predicted_label") != BENIGN).orderBy(*newest).limit(n)


def dataset_head(df: DataFrame, order: str, n: int = 25) -> DataFrame:
    """The first ``n`` rows, each with the table's row count as ``total_rows``."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(order).limit(n).withColumn("total_rows", total)


def incident_report(scored: DataFrame, order: Sequence[str], columns: Sequence[str],
                    threats: int = 15) -> DataFrame:
    """One row: time span, posture, key figures, class counts, last flow and last threats."""
    record = F.struct(*columns)
    newest = [F.desc(c) for c in order]
    last = scored.orderBy(*newest).limit(1).select(record.alias("flow"))
    recent = latest_threats(scored, order, threats).agg(
        # At most `threats` rows are gathered, newest first.
        F.reverse(F.array_sort(F.collect_list(F.struct(*order, record.alias("flow"))))).alias("rows")
    ).select(F.transform("rows", lambda r: r["flow"]).alias("last_threats"))
    threat = F.coalesce(F.col("predicted_label") != BENIGN, F.lit(False))
    # Counts and greatest times are hash aggregates; the flows come from two top-n scans.
    per_class = scored.groupBy("predicted_label").agg(F.count(F.lit(1)).alias("n"), F.max(order[0]).alias("at"))
    known = F.filter(F.array_sort(F.collect_list(F.struct("predicted_label", "n"))), lambda c: c["predicted_label"].isNotNull())
    return per_class.agg(
        F.max("at").alias("reported_at"),
        F.when(F.max(threat), "severe").otherwise("secure").alias("status"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("flows_evaluated"),
        F.coalesce(F.sum(F.when(threat, F.col("n"))), F.lit(0)).alias("threats"),
        # One entry per class; flows without a label count in the total only.
        F.map_from_entries(known).alias("class_counts"),
    ).withColumn("last_flow", last.scalar()).withColumn("last_threats", recent.scalar())
