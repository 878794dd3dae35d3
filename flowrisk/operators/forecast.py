"""Forecast of the next detection's risk from the trend over the last ones.

The trend needs each detection's predicted label, attack probability and risk
score. Positions are counted back from the newest row, so the sums stay small
numbers however long the series is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from flowrisk.functions.numeric import clamp, half_up, settled
from flowrisk.functions.risk import risk_level
from flowrisk.operators.ordered import HOT_ROWS, KeyOrder
from flowrisk.schema import (
    BENIGN, FORECAST_SCHEMA, MOMENTUM_WEIGHT, RATIO_WEIGHT, SLOPE_SCALE, SLOPE_WEIGHT,
    TREND_WINDOW,
)

LABEL, ATTACK, RISK = "predicted_label", "forecast_attack_prob", "risk_score"
FORECAST_COLUMNS = FORECAST_SCHEMA.fieldNames()
_TREND = ["_n", "_slope", "_momentum", "_suspicious", "_newest"]


def observed_attack_prob(p_benign: Column) -> Column:
    """The trend's attack probability: without a benign probability it is 1."""
    return 1.0 - F.coalesce(p_benign, F.lit(0.0))


def _trend(df: DataFrame, back: Callable[[Column, int], Column], window: int) -> DataFrame:
    """Add count, slope, momentum and suspicious rows over the last ``window`` rows.

    ``back(column, i)`` is the column ``i`` rows earlier, NULL before the first row.
    """
    flag = F.coalesce((F.col(LABEL) != BENIGN).cast("int"), F.lit(1))
    steps = range(1, window)
    df = df.select(
        "*", flag.alias("_f0"),
        *[back(flag, i).alias(f"_f{i}") for i in steps],
        *[back(F.col(ATTACK), i).alias(f"_a{i}") for i in steps],
        *[back(F.col(RISK), i).alias(f"_r{i}") for i in steps],
    )
    zero = F.lit(0.0)
    attack = [F.coalesce(F.col(ATTACK), zero)] + [F.coalesce(F.col(f"_a{i}"), zero) for i in steps]
    risk = [F.coalesce(F.col(RISK), zero)] + [F.coalesce(F.col(f"_r{i}"), zero) for i in steps]
    df = df.select(
        "*",
        (F.lit(1) + sum((F.col(f"_f{i}").isNotNull().cast("int") for i in steps), F.lit(0))).alias("_n"),
        (F.col("_f0") + sum((F.coalesce(F.col(f"_f{i}"), F.lit(0)) for i in steps), F.lit(0))).alias("_suspicious"),
        sum(attack[1:], attack[0]).alias("_a"),
        sum((float(i) * attack[i] for i in steps), zero).alias("_ia"),
        sum(risk[1:], risk[0]).alias("_r"),
        sum((float(i) * risk[i] for i in steps), zero).alias("_ir"),
    )
    n = F.col("_n").cast("double")
    # Least squares over positions 0, -1, ..., 1-n; weights n, n-1, ..., 1.
    slope = ((n - 1.0) / 2.0 * F.col("_a") - F.col("_ia")) * 12.0 / (n * (n * n - 1.0))
    momentum = (n * F.col("_r") - F.col("_ir")) * 2.0 / (n * (n + 1.0))
    helpers = [f"_f{i}" for i in range(window)] + [f"_{x}{i}" for x in "ar" for i in steps]
    return df.select(
        "*",
        F.when(F.col("_n") >= 2, slope).alias("_slope"),
        momentum.alias("_momentum"),
        F.coalesce(F.col(ATTACK), zero).alias("_newest"),
    ).drop(*helpers, "_a", "_ia", "_r", "_ir")


def _outputs(window: int) -> dict[str, Column]:
    n, slope, momentum = F.col("_n"), F.col("_slope"), settled(F.col("_momentum"))
    warm = n >= 2
    slope_signal = settled(clamp(slope * SLOPE_SCALE, 0.0, 100.0))
    ratio_signal = F.col("_suspicious") / n * 100.0
    blend = SLOPE_WEIGHT * slope_signal + MOMENTUM_WEIGHT * momentum + RATIO_WEIGHT * ratio_signal
    score = F.when(warm, settled(clamp(blend, 0.0, 100.0))).otherwise(0.0)
    direction = (
        F.when(slope_signal >= 40.0, "SHARP_RISE")
        .when(slope_signal >= 15.0, "STEADY_RISE")
        .when(slope_signal > 5.0, "SLIGHT_RISE")
    )
    pressure = F.when(momentum >= 70.0, "HIGH_RISK").when(momentum >= 35.0, "ELEVATED_RISK")
    flagged = F.when(F.col("_suspicious") > 0, "FLAGGED")
    found = F.array_compact(F.array(direction, pressure, flagged))
    codes = (
        F.when(~warm, F.array(F.lit("TOO_SHORT")))
        .when(F.size(found) == 0, F.array(F.lit("STABLE")))
        .otherwise(found)
    )
    return {
        "forecast_risk_score": half_up(score, 2),
        "forecast_risk_level": risk_level(score),  # on the unrounded score
        "forecast_confidence": F.when(warm, half_up(n / float(window), 3)).otherwise(0.0),
        "windows_observed": n,
        "trend_slope": settled(slope),
        "trend_current": settled(F.col("_newest")),
        "trend_momentum": momentum,
        "trend_flagged": F.col("_suspicious"),
        "reason_codes": codes,
        "forecast_reason": _sentence(codes, settled(slope), settled(F.col("_newest")), momentum),
    }


# What is said for each reason; numbers are rounded before they are written, half away from zero.
_RISES = {"SHARP_RISE": "sharply", "STEADY_RISE": "steadily", "SLIGHT_RISE": "slightly"}
_PRESSURES = {"HIGH_RISK": "high", "ELEVATED_RISK": "elevated"}


def _sentence(codes: Column, slope: Column, current: Column, momentum: Column) -> Column:
    """The reason in words and numbers."""
    n = F.col("_n")
    rise = F.format_string("attacks grow %s likelier (%+.3f a detection, now %.0f%%)", F.coalesce(
        *[F.when(F.array_contains(codes, c), word) for c, word in _RISES.items()]), half_up(slope, 3), half_up(current * 100.0, 0))
    pressure = F.format_string("risk is %s (%.0f of 100, newest counting most)", F.coalesce(
        *[F.when(F.array_contains(codes, c), word) for c, word in _PRESSURES.items()]), half_up(momentum, 0))
    any_of = lambda names: F.arrays_overlap(codes, F.array(*map(F.lit, names)))
    return (
        F.when(F.array_contains(codes, "TOO_SHORT"), F.format_string("%d detection, too few for a trend", n))
        .when(F.array_contains(codes, "STABLE"), F.format_string("steady over %d detections", n))
        .otherwise(F.concat_ws(
            "; ", F.when(any_of(_RISES), rise), F.when(any_of(_PRESSURES), pressure),
            F.when(F.array_contains(codes, "FLAGGED"), F.format_string("%d of %d detections flagged", F.col("_suspicious"), n))))
    )


def _check(window: int) -> None:
    if window < 2:
        raise ValueError("a trend needs a window of at least 2 detections")


def forecast(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             window: int = TREND_WINDOW, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Forecast after every detection of each key; no keys make one series."""
    _check(window)

    def add(rows: DataFrame, spec: WindowSpec) -> DataFrame:
        trend = _trend(rows, lambda c, i: F.lag(c, i).over(spec), window)
        return trend.withColumns(_outputs(window)).drop(*_TREND)

    return KeyOrder.of(df, keys, order, hot_rows).frames(window, add).rows()


def current_forecast(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     window: int = TREND_WINDOW) -> DataFrame:
    """Forecast after the newest detection of each key, one row per key.

    Only ``window`` rows per key and map task reach the shuffle.
    """
    _check(window)
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    last = (
        df.withColumn("_last", F.row_number().over(newest_first))
        .filter(F.col("_last") <= window)
    )
    trend = _trend(last, lambda c, i: F.lead(c, i).over(newest_first), window)
    return trend.filter(F.col("_last") == 1).withColumns(_outputs(window)).drop("_last", *_TREND)


def early_warnings(forecasts: DataFrame) -> DataFrame:
    return forecasts.filter(F.col("forecast_risk_level").isin("HIGH", "CRITICAL"))


def trajectory(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               window: int = TREND_WINDOW, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Forecasts beside what followed: the previous forecast and its error against this risk.

    Also the speed of the attack probability (its slope) and the change of that speed.
    """
    _check(window)

    def add(rows: DataFrame, spec: WindowSpec) -> DataFrame:
        trend = _trend(rows, lambda c, i: F.lag(c, i).over(spec), window)
        trend = trend.withColumns(_outputs(window))
        trend = trend.select(
            "*",
            F.lag("forecast_risk_score").over(spec).alias("previous_forecast"),
            F.col("_slope").alias("threat_velocity"),
            (F.col("_slope") - F.lag("_slope").over(spec)).alias("threat_acceleration"),
            F.lag("_n").over(spec).alias("_before"),
        )
        # A forecast from a single detection is no forecast.
        previous = F.when(F.col("_before") >= 2, F.col("previous_forecast"))
        return (
            trend.withColumn("previous_forecast", previous)
            .withColumn("forecast_error", F.col(RISK) - F.col("previous_forecast"))
            .drop("_before", *_TREND)
        )

    return KeyOrder.of(df, keys, order, hot_rows).frames(window + 1, add).rows()
