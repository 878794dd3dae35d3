"""Queries on rolling statistics, forecasts, sessions and time buckets."""

from pyspark.sql import functions as F

from flowrisk.functions.numeric import half_up
from flowrisk.operators import forecast as trend
from flowrisk.operators import report, rolling
from flowrisk.operators.features import derive_features
from flowrisk.plans.registry import HOST, ORDER, flows, query, r6, scored, sql6
from flowrisk.schema import ROLLING_COLUMNS

_RESULT = ["forecast_risk_score", "forecast_risk_level", "forecast_confidence", "windows_observed"]
_RESULT_SQL = ", ".join(_RESULT)
_OBSERVED = ["flow_id", "host_id", "ts", "predicted_label", "forecast_attack_prob", "risk_score"]


def _observed(spark, folder):
    return scored(spark, folder).select(*_OBSERVED)


def _rolling_sql(partition):
    over = f"OVER ({partition} ORDER BY ts, flow_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
    columns = ", ".join(
        f"{sql6(f'avg({c}) {over}')} AS {c}_rolling_mean_10, "
        f"{sql6(f'coalesce(stddev_samp({c}) {over}, 0e0)')} AS {c}_rolling_std_10" for c in ROLLING_COLUMNS)
    return f"""SELECT flow_id, {columns} FROM (SELECT *, src_bytes + dst_bytes AS total_bytes,
                 (src_bytes + dst_bytes) / (duration + 0.001e0) AS bytes_per_sec FROM flows)"""


def _rolling(spark, folder, keys):
    rows = derive_features(flows(spark, folder)).select("flow_id", "host_id", "ts", *ROLLING_COLUMNS)
    made = rolling.rolling_stats(rows, keys, ORDER)
    return made.select("flow_id", *[r6(c) for c in made.columns if "_rolling_" in c])


@query(_rolling_sql("PARTITION BY host_id"))
def rolling_stats(spark, folder):
    return _rolling(spark, folder, HOST)


@query(_rolling_sql(""))
def rolling_global(spark, folder):
    return _rolling(spark, folder, [])


@query(f"SELECT flow_id, host_id, {_RESULT_SQL} FROM forecasts", "forecasts")
def forecast_all(spark, folder):
    return trend.forecast(_observed(spark, folder), HOST, ORDER).select("flow_id", "host_id", *_RESULT)


@query(f"""SELECT host_id, flow_id, ts, {_RESULT_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY host_id
             ORDER BY ts DESC, flow_id DESC) AS back FROM forecasts) WHERE back = 1""", "forecasts")
def forecast_current(spark, folder):
    return trend.current_forecast(_observed(spark, folder), HOST, ORDER).select("host_id", "flow_id", "ts", *_RESULT)


_GLOBAL_TREND = """
  SELECT flow_id, floor(raw * 1e2 + 0.5e0) / 1e2 AS forecast_risk_score,
    CASE WHEN raw >= 80 THEN 'CRITICAL' WHEN raw >= 50 THEN 'HIGH' WHEN raw >= 25 THEN 'MEDIUM' ELSE 'LOW' END
      AS forecast_risk_level
  FROM (SELECT flow_id, CASE WHEN n < 2 THEN 0e0 ELSE floor(greatest(0e0, least(100e0,
      0.45e0 * floor(greatest(0e0, least(100e0, slope * 1000e0)) * 1e9 + 0.5e0) / 1e9
      + 0.35e0 * floor(momentum / (n * (n + 1) / 2e0) * 1e9 + 0.5e0) / 1e9
      + 20e0 * suspicious / n)) * 1e9 + 0.5e0) / 1e9 END AS raw
    FROM (SELECT flow_id, count(*) OVER w AS n,
        CASE WHEN count(*) OVER w >= 2 THEN regr_slope(forecast_attack_prob, rn) OVER w ELSE 0e0 END AS slope,
        sum(risk_score * rn) OVER w - (min(rn) OVER w - 1) * sum(risk_score) OVER w AS momentum,
        sum(CAST(is_attack AS INTEGER)) OVER w AS suspicious
      FROM (SELECT *, row_number() OVER (ORDER BY ts, flow_id) AS rn FROM scored)
      WINDOW w AS (ORDER BY ts, flow_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)))"""


@query(_GLOBAL_TREND, "scored")
def forecast_global(spark, folder):
    """One series over all hosts, in order of arrival."""
    return trend.forecast(_observed(spark, folder), [], ORDER).select(
        "flow_id", "forecast_risk_score", "forecast_risk_level")


# The numbers behind a reason, and the sentence made of them.
_REASON = ["slope", "current", "momentum", "flagged"]


def _reason():
    return [*[half_up(F.col(f"trend_{c}"), 6).alias(c) for c in _REASON[:3]], F.col("trend_flagged").alias("flagged")]


_REASON_SQL = f"""CASE WHEN n >= 2 THEN {sql6("floor(slope * 1e9 + 0.5e0) / 1e9")} END AS slope,
            {sql6("floor(forecast_attack_prob * 1e9 + 0.5e0) / 1e9")} AS current,
            {sql6("momentum")} AS momentum, CAST(suspicious AS INTEGER) AS flagged"""
_SENTENCE_SQL = """CASE WHEN n < 2 THEN format('{} detection, too few for a trend', n)
              WHEN slope_signal <= 5 AND momentum < 35 AND suspicious = 0 THEN format('steady over {} detections', n)
              ELSE concat_ws('; ',
                CASE WHEN slope_signal > 5 THEN format('attacks grow {} likelier ({:+.3f} a detection, now {:.0f}%)',
                  CASE WHEN slope_signal >= 40 THEN 'sharply' WHEN slope_signal >= 15 THEN 'steadily' ELSE 'slightly' END,
                  floor(floor(slope * 1e9 + 0.5e0) / 1e9 * 1e3 + 0.5e0) / 1e3,
                  floor(floor(forecast_attack_prob * 1e9 + 0.5e0) / 1e9 * 100e0 + 0.5e0)) END,
                CASE WHEN momentum >= 35 THEN format('risk is {} ({:.0f} of 100, newest counting most)',
                  CASE WHEN momentum >= 70 THEN 'high' ELSE 'elevated' END, floor(momentum + 0.5e0)) END,
                CASE WHEN suspicious > 0 THEN format('{} of {} detections flagged', CAST(suspicious AS BIGINT), n) END) END AS forecast_reason"""


@query(f"""SELECT flow_id, {_REASON_SQL}, {_SENTENCE_SQL}, CASE WHEN n < 2 THEN 'TOO_SHORT' ELSE coalesce(nullif(concat_ws('+',
            CASE WHEN slope_signal >= 40 THEN 'SHARP_RISE' WHEN slope_signal >= 15 THEN 'STEADY_RISE'
              WHEN slope_signal > 5 THEN 'SLIGHT_RISE' END,
            CASE WHEN momentum >= 70 THEN 'HIGH_RISK' WHEN momentum >= 35 THEN 'ELEVATED_RISK' END,
            CASE WHEN suspicious > 0 THEN 'FLAGGED' END), ''), 'STABLE') END AS reasons FROM trend""", "trend")
def forecast_reason_codes(spark, folder):
    made = trend.forecast(_observed(spark, folder), HOST, ORDER)
    return made.select("flow_id", *_reason(), "forecast_reason", F.array_join("reason_codes", "+").alias("reasons"))


@query(f"SELECT flow_id, host_id, {_RESULT_SQL} FROM forecasts WHERE forecast_risk_level IN ('HIGH', 'CRITICAL')",
       "forecasts")
def early_warnings(spark, folder):
    made = trend.forecast(_observed(spark, folder), HOST, ORDER)
    return trend.early_warnings(made).select("flow_id", "host_id", *_RESULT)


@query(f"""SELECT host_id, count(e) AS compared, {sql6("avg(abs(e))")} AS mean_error
          FROM (SELECT host_id, CASE WHEN lag(n) OVER w >= 2 THEN risk_score - lag(forecast_risk_score) OVER w END AS e
            FROM forecasts WINDOW w AS (PARTITION BY host_id ORDER BY ts, flow_id)) GROUP BY 1""", "forecasts")
def forecast_error(spark, folder):
    made = trend.trajectory(_observed(spark, folder), HOST, ORDER)
    errors = made.groupBy("host_id").agg(F.count("forecast_error").alias("compared"),
                                         F.avg(F.abs("forecast_error")).alias("mean_error"))
    return errors.withColumn("mean_error", r6("mean_error"))


@query(f"""SELECT flow_id, {sql6("v")} AS threat_velocity, {sql6("v - lag(v) OVER (PARTITION BY host_id ORDER BY ts, flow_id)")}
            AS threat_acceleration
          FROM (SELECT *, CASE WHEN n >= 2 THEN slope END AS v FROM trend)""", "trend")
def threat_velocity(spark, folder):
    made = trend.trajectory(_observed(spark, folder), HOST, ORDER)
    return made.select("flow_id", r6("threat_velocity"), r6("threat_acceleration"))


@query("SELECT flow_id, row_number() OVER (PARTITION BY host_id ORDER BY ts, flow_id) AS flow_number FROM flows")
def flow_counter(spark, folder):
    rows = flows(spark, folder).select("flow_id", "host_id", "ts")
    return rolling.flow_counter(rows, HOST, ORDER).select("flow_id", "flow_number")


GAP = "8 hours"
SESSIONS_SQL = """
  SELECT *, CAST(sum(starts) OVER (PARTITION BY host_id ORDER BY ts, flow_id) AS BIGINT) AS session_id
  FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY host_id ORDER BY ts, flow_id) + INTERVAL 8 HOUR
          THEN 0 ELSE 1 END AS starts FROM scored)"""


@query(f"""SELECT host_id, session_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS flows,
            count(*) FILTER (is_attack) AS threats, max(risk_score) AS risk_score
          FROM ({SESSIONS_SQL}) GROUP BY 1, 2""", "scored")
def session_windows(spark, folder):
    rows = rolling.sessions(_observed(spark, folder), HOST, "ts", ORDER, GAP)
    return rows.groupBy("host_id", "session_id").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count(F.lit(1)).alias("flows"),
        F.count_if(F.col("predicted_label") != "Normal").alias("threats"), F.max("risk_score").alias("risk_score"))


SESSION_FORECAST_SQL = f"""SELECT flow_id, session_id, floor(raw * 1e2 + 0.5e0) / 1e2 AS forecast_risk_score,
    CAST(n AS INTEGER) AS windows_observed
  FROM (SELECT flow_id, session_id, n, CASE WHEN n < 2 THEN 0e0 ELSE floor(greatest(0e0, least(100e0,
      0.45e0 * floor(greatest(0e0, least(100e0, slope * 1000e0)) * 1e9 + 0.5e0) / 1e9
      + 0.35e0 * floor(momentum / (n * (n + 1) / 2e0) * 1e9 + 0.5e0) / 1e9
      + 20e0 * suspicious / n)) * 1e9 + 0.5e0) / 1e9 END AS raw
    FROM (SELECT flow_id, session_id, count(*) OVER w AS n,
        CASE WHEN count(*) OVER w >= 2 THEN regr_slope(forecast_attack_prob, rn) OVER w ELSE 0e0 END AS slope,
        sum(risk_score * rn) OVER w - (min(rn) OVER w - 1) * sum(risk_score) OVER w AS momentum,
        sum(CAST(is_attack AS INTEGER)) OVER w AS suspicious
      FROM (SELECT *, row_number() OVER (PARTITION BY host_id, session_id ORDER BY ts, flow_id) AS rn
            FROM ({SESSIONS_SQL}))
      WINDOW w AS (PARTITION BY host_id, session_id ORDER BY ts, flow_id
                   ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)))"""
QUIET_SQL = f"SELECT flow_id, forecast_risk_score, windows_observed FROM ({SESSION_FORECAST_SQL})"


@query(SESSION_FORECAST_SQL, "scored")
def forecast_sessions(spark, folder):
    """The trend of a host starts anew after a quiet period."""
    rows = rolling.sessions(_observed(spark, folder), HOST, "ts", ORDER, GAP)
    made = trend.forecast(rows, [*HOST, "session_id"], ORDER)
    return made.select("flow_id", "session_id", "forecast_risk_score", "windows_observed")


BUCKETS_SQL = f"""
  SELECT host_id, date_trunc('day', ts) AS bucket_start, count(*) AS flows,
    count(*) FILTER (is_attack) AS threats, {sql6("avg(forecast_attack_prob)")} AS forecast_attack_prob,
    {sql6("avg(risk_score)")} AS mean_risk, max(risk_score) AS risk_score
  FROM scored GROUP BY 1, 2"""


@query(f"""SELECT *, CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
            WHEN risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
            CASE WHEN threats > 0 THEN 'Attack' ELSE 'Normal' END AS predicted_label
          FROM ({BUCKETS_SQL})""", "scored")
def time_bucket_risk(spark, folder):
    made = report.risk_by_time(_observed(spark, folder), "1 day", keys=HOST)
    return made.withColumns({c: r6(c) for c in ("forecast_attack_prob", "mean_risk")})


SLIDING_SQL = f"""
  SELECT *, CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
      WHEN risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
    CASE WHEN threats > 0 THEN 'Attack' ELSE 'Normal' END AS predicted_label
  FROM (SELECT host_id, window_start, window_start + INTERVAL 3 DAY AS window_end, count(*) AS flows,
      count(*) FILTER (is_attack) AS threats, {sql6("avg(forecast_attack_prob)")} AS forecast_attack_prob,
      {sql6("avg(risk_score)")} AS mean_risk, max(risk_score) AS risk_score
    FROM (SELECT *, date_trunc('day', ts) - back * INTERVAL 1 DAY AS window_start FROM scored, (VALUES (0), (1), (2)) AS v(back))
    GROUP BY 1, 2, 3)"""


@query(SLIDING_SQL, "scored")
def sliding_risk(spark, folder):
    """Three-day windows, one beginning every day."""
    made = report.sliding_risk(_observed(spark, folder), "3 days", "1 day", keys=HOST)
    return made.withColumns({c: r6(c) for c in ("forecast_attack_prob", "mean_risk")})


BUCKET_FORECAST_SQL = f"""SELECT host_id, bucket_start, floor(raw * 1e2 + 0.5e0) / 1e2 AS forecast_risk_score,
    CAST(n AS INTEGER) AS windows_observed
  FROM (SELECT host_id, bucket_start, n, CASE WHEN n < 2 THEN 0e0 ELSE floor(greatest(0e0, least(100e0,
      0.45e0 * floor(greatest(0e0, least(100e0, slope * 1000e0)) * 1e9 + 0.5e0) / 1e9
      + 0.35e0 * floor(momentum / (n * (n + 1) / 2e0) * 1e9 + 0.5e0) / 1e9
      + 20e0 * suspicious / n)) * 1e9 + 0.5e0) / 1e9 END AS raw
    FROM (SELECT host_id, bucket_start, count(*) OVER w AS n,
        CASE WHEN count(*) OVER w >= 2 THEN regr_slope(forecast_attack_prob, rn) OVER w ELSE 0e0 END AS slope,
        sum(risk_score * rn) OVER w - (min(rn) OVER w - 1) * sum(risk_score) OVER w AS momentum,
        sum(CASE WHEN threats > 0 THEN 1 ELSE 0 END) OVER w AS suspicious
      FROM (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY bucket_start) AS rn FROM ({BUCKETS_SQL}))
      WINDOW w AS (PARTITION BY host_id ORDER BY bucket_start ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)))"""


@query(BUCKET_FORECAST_SQL, "scored")
def time_bucket_forecast(spark, folder):
    buckets = report.risk_by_time(_observed(spark, folder), "1 day", keys=HOST)
    buckets = buckets.withColumn("forecast_attack_prob", half_up(F.col("forecast_attack_prob"), 6))
    return trend.forecast(buckets, HOST, ["bucket_start"]).select(
        "host_id", "bucket_start", "forecast_risk_score", "windows_observed")
