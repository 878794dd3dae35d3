"""Stateless and aggregated views of a stream of scored flows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flowrisk.operators.report import kpis, risk_by_time
from flowrisk.schema import BENIGN


def event_time(df: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Watermark on ``ts``; a timestamp without zone is read in the session's zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("alert_triggered"))


def running_kpis(scored: DataFrame) -> DataFrame:
    """Key figures so far; update or complete mode."""
    return kpis(scored)


def flow_counts(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flows and threats per key so far; update or complete mode."""
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("flows"), F.count_if(F.col("predicted_label") != BENIGN).alias("threats"))


def bucket_risk(scored: DataFrame, bucket: str, ts: str = "ts", keys: Sequence[str] = ()) -> DataFrame:
    """Risk per key and time bucket, final once the watermark has passed the bucket."""
    return risk_by_time(scored, bucket, ts, keys)


def session_activity(scored: DataFrame, keys: Sequence[str], gap: str, ts: str = "ts") -> DataFrame:
    """Flows, threats and greatest risk per key and activity session."""
    spans = scored.groupBy(*keys, F.session_window(ts, gap).alias("span")).agg(
        F.count(F.lit(1)).alias("flows"),
        F.count_if(F.col("predicted_label") != BENIGN).alias("threats"),
        F.max("risk_score").alias("risk_score"),
    )
    return spans.select(*keys, F.col("span.start").alias("session_start"),
                        F.col("span.end").alias("session_end"), "flows", "threats", "risk_score")
