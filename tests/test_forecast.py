import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowrisk.operators.forecast import FORECAST_COLUMNS, current_forecast, forecast, trajectory
from flowrisk.operators.rolling import sessions

SCHEMA = "host int, at int, predicted_label string, forecast_attack_prob double, risk_score double"
N = "Normal"
FLAT = [(N, a, r) for a, r in zip((.06, .08, .09, .07, .10, .08, .06, .09), (1.8, 2.4, 2.7, 2.1, 3.0, 2.4, 1.8, 2.7))]
RISING = list(zip((N, N, N, "PortScan", "DoS", "DoS", "DoS", "DoS"), (.05, .12, .22, .36, .51, .65, .77, .88),
                  (2.0, 4.2, 11.0, 25.5, 45.0, 56.5, 64.0, 71.6)))
RECOVERY = list(zip(("BruteForce",) * 4 + (N,) * 4, (.80, .85, .82, .78, .28, .15, .09, .06),
                    (62.5, 65.5, 63.5, 59.6, 8.4, 4.5, 2.7, 1.8)))
EXPECTED = {
    0: [(s, "LOW") for s in (0.00, 9.77, 7.61, 2.61, 4.04, 2.67, 0.97, 1.43)],
    1: list(zip((0.00, 32.71, 40.78, 55.09, 61.64, 66.82, 70.90, 74.32),
                ("LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "HIGH", "HIGH", "HIGH"))),
    2: list(zip((0.00, 65.07, 46.90, 41.78, 31.50, 24.86, 20.31, 17.05),
                ("LOW", "HIGH", "MEDIUM", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW"))),
}


def rows_of(series):
    return [(host, i, *row) for host, rows in series.items() for i, row in enumerate(rows)]


def brute(rows, window=8):
    """Score, level, count and raw score of each prefix, straight from the definition."""
    out = []
    for i in range(len(rows)):
        last = rows[max(0, i - window + 1):i + 1]
        n = len(last)
        if n < 2:
            out.append((0.0, n))
            continue
        xm, ym = (n - 1) / 2, sum(r[1] for r in last) / n
        slope = sum((x - xm) * (r[1] - ym) for x, r in enumerate(last)) / sum((x - xm) ** 2 for x in range(n))
        momentum = sum((x + 1) * r[2] for x, r in enumerate(last)) / (n * (n + 1) / 2)
        ratio = 100 * sum(r[0] != N for r in last) / n
        out.append((min(100, max(0, .45 * min(100, max(0, slope * 1000)) + .35 * momentum + .2 * ratio)), n))
    return out


def test_scenarios(spark):
    df = spark.createDataFrame(rows_of({0: FLAT, 1: RISING, 2: RECOVERY}), SCHEMA)
    got = {(r["host"], r["at"]): r for r in forecast(df, ["host"], ["at"]).collect()}
    for host, expected in EXPECTED.items():
        for at, (score, level) in enumerate(expected):
            r = got[host, at]
            assert r["forecast_risk_score"] == pytest.approx(score, abs=0.0101)
            assert r["forecast_risk_level"] == level
            assert r["windows_observed"] == at + 1
            assert r["forecast_confidence"] == (0.0 if at == 0 else (at + 1) / 8)
    assert got[0, 0]["reason_codes"] == ["TOO_SHORT"]
    assert got[1, 7]["reason_codes"] == ["SHARP_RISE", "ELEVATED_RISK", "FLAGGED"]
    assert got[0, 7]["reason_codes"] == ["STABLE"]
    assert got[0, 7]["forecast_reason"] == "steady over 8 detections"
    assert got[1, 0]["forecast_reason"] == "1 detection, too few for a trend" and got[1, 0]["trend_slope"] is None
    parts = got[1, 7]["forecast_reason"].split("; ")
    assert parts[0].startswith("attacks grow sharply likelier (+") and parts[1].startswith("risk is elevated (") and len(parts) == 3
    assert parts[2] == f"{got[1, 7]['trend_flagged']} of 8 detections flagged"


series = st.lists(st.tuples(st.sampled_from([N, "DoS"]), st.floats(0, 1), st.floats(0, 100)), min_size=1, max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(series, min_size=1, max_size=4))
def test_any_series(spark, all_series):
    df = spark.createDataFrame(rows_of(dict(enumerate(all_series))), SCHEMA)
    got = {(r["host"], r["at"]): r for r in forecast(df, ["host"], ["at"]).collect()}
    for host, rows in enumerate(all_series):
        for at, (score, n) in enumerate(brute(rows)):
            r = got[host, at]
            assert r["forecast_risk_score"] == pytest.approx(score, abs=0.00501)
            assert r["windows_observed"] == n
            assert 0 <= r["forecast_risk_score"] <= 100


@pytest.mark.parametrize("window", [2, 3, 12])
def test_other_windows(spark, window):
    df = spark.createDataFrame(rows_of({0: RISING + RECOVERY}), SCHEMA)
    got = sorted(forecast(df, ["host"], ["at"], window).collect(), key=lambda r: r["at"])
    for r, (score, n) in zip(got, brute(RISING + RECOVERY, window)):
        assert r["forecast_risk_score"] == pytest.approx(score, abs=0.00501)
        assert r["windows_observed"] == n


def test_window_of_one_is_refused(spark):
    df = spark.createDataFrame(rows_of({0: FLAT}), SCHEMA)
    with pytest.raises(ValueError):
        forecast(df, ["host"], ["at"], 1)


def test_current_is_the_last_of_all(spark):
    df = spark.createDataFrame(rows_of({0: FLAT + RISING, 1: RISING[:1], 2: RECOVERY + FLAT[:3]}), SCHEMA)
    every = {(r["host"], r["at"]): r for r in forecast(df, ["host"], ["at"]).collect()}
    now = current_forecast(df, ["host"], ["at"]).collect()
    assert {(r["host"], r["at"]) for r in now} == {(0, 15), (1, 0), (2, 10)}
    for r in now:
        assert [r[c] for c in FORECAST_COLUMNS] == [every[r["host"], r["at"]][c] for c in FORECAST_COLUMNS]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert forecast(df, ["host"], ["at"]).count() == 0
    assert forecast(df, [], ["at"]).count() == 0
    assert current_forecast(df, ["host"], ["at"]).count() == 0


def test_trajectory_compares_with_the_next(spark):
    df = spark.createDataFrame(rows_of({0: RISING}), SCHEMA)
    made = sorted(trajectory(df, ["host"], ["at"]).collect(), key=lambda r: r["at"])
    assert [r["previous_forecast"] for r in made[:2]] == [None, None]
    for before, r in zip(made[1:], made[2:]):
        assert r["previous_forecast"] == before["forecast_risk_score"]
        assert r["forecast_error"] == pytest.approx(r["risk_score"] - before["forecast_risk_score"])
    assert made[1]["threat_velocity"] == pytest.approx(0.07)


def test_sessions_restart_the_trend(spark):
    df = spark.createDataFrame(rows_of({0: RISING}), SCHEMA).withColumn(
        "ts", F.timestamp_seconds(F.col("at") * 60 + F.when(F.col("at") >= 4, 3600).otherwise(0)))
    made = forecast(sessions(df, ["host"], "ts", ["ts", "at"], "30 minutes"), ["host", "session_id"], ["ts", "at"])
    rows = sorted(made.collect(), key=lambda r: r["at"])
    assert [r["session_id"] for r in rows] == [1] * 4 + [2] * 4
    assert [r["windows_observed"] for r in rows] == [1, 2, 3, 4] * 2
