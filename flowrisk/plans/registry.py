"""Registry of the queries over the given tables, each with its check in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowrisk.functions.numeric import half_up
from flowrisk.sources.event_flows import detections, dirty, flows_of, read_events

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

# The flows, dirty flows and detections of `event_flows`, spelled out in SQL.
_VIEWS = {
    "flows": """
      SELECT *, CASE WHEN unique_dst_ports >= 20 AND event_type = 'view' THEN 'PortScan'
                     WHEN failed_logins >= 3 AND event_type = 'error' THEN 'BruteForce'
                     WHEN packet_rate >= 400e0 THEN 'DoS' ELSE 'Normal' END AS label
      FROM (SELECT event_id AS flow_id, user_id AS host_id, ts, k, event_type,
              value / 4e0 AS duration, value * 37e0 + k AS src_bytes, k * 23e0 + 5e0 AS dst_bytes,
              value * 8e0 AS packet_rate, k * 4 + 1 AS connections_to_same_host,
              CASE WHEN event_type = 'view' THEN 1 + k % 40 ELSE 1 + k % 3 END AS unique_dst_ports,
              CASE WHEN event_type = 'error' THEN k % 12 ELSE 0 END AS failed_logins,
              CAST(CASE k % 7 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 22 WHEN 3 THEN 21
                WHEN 4 THEN 1433 WHEN 5 THEN 3306 ELSE 8080 END AS BIGINT) AS dst_port,
              CASE WHEN event_id % 5 = 0 THEN 'udp' ELSE 'tcp' END AS protocol_type
            FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events))""",
    # Numbers already coerced, labels already trimmed: what cleaning has to arrive at.
    "cleaned": """
      SELECT * REPLACE (
        CASE WHEN flow_id % 17 = 0 OR flow_id % 31 = 0 THEN NULL ELSE src_bytes END AS src_bytes,
        CASE WHEN flow_id % 29 = 0 THEN NULL ELSE duration END AS duration,
        CASE WHEN flow_id % 37 = 0 THEN NULL ELSE protocol_type END AS protocol_type)
      FROM flows WHERE flow_id % 41 <> 0""",
    "classified": """
      SELECT * EXCLUDE (w_b, w_d, w_n, w_p),
        w_b / CAST(w_b + w_d + w_n + w_p AS DOUBLE) AS p_b, w_d / CAST(w_b + w_d + w_n + w_p AS DOUBLE) AS p_d,
        w_n / CAST(w_b + w_d + w_n + w_p AS DOUBLE) AS p_n, w_p / CAST(w_b + w_d + w_n + w_p AS DOUBLE) AS p_p,
        CASE greatest(w_b, w_d, w_n, w_p) WHEN w_b THEN 'BruteForce' WHEN w_d THEN 'DoS'
          WHEN w_n THEN 'Normal' ELSE 'PortScan' END AS predicted_label
      FROM (SELECT *,
          1 + (flow_id * 15485863) % 79 + CASE label WHEN 'BruteForce' THEN 60 ELSE 0 END AS w_b,
          1 + (flow_id * 104729 + k * 17) % 89 + CASE label WHEN 'DoS' THEN 60 ELSE 0 END AS w_d,
          1 + (flow_id * 7919 + k * 31) % 97 + CASE label WHEN 'Normal' THEN 60 ELSE 0 END AS w_n,
          1 + (flow_id * 1299709 + k) % 83 + CASE label WHEN 'PortScan' THEN 60 ELSE 0 END AS w_p
        FROM flows)""",
    "scored": """
      SELECT *, CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
                     WHEN risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
      FROM (SELECT *, 1e0 - p_n AS forecast_attack_prob, predicted_label <> 'Normal' AS is_attack,
              floor(greatest(p_b, p_d, p_n, p_p) * 1e4 + 0.5e0) / 1e4 AS confidence,
              floor((1e0 - p_n) * 1e4 + 0.5e0) / 1e4 AS attack_probability,
              floor(CASE predicted_label WHEN 'Normal' THEN (1e0 - p_n) * 30e0
                WHEN 'BruteForce' THEN 0.85e0 * 70e0 + p_b * 30e0 WHEN 'DoS' THEN 0.90e0 * 70e0 + p_d * 30e0
                ELSE 0.65e0 * 70e0 + p_p * 30e0 END * 1e2 + 0.5e0) / 1e2 AS risk_score
            FROM classified)""",
    # Trend signals over the last 8 detections of a host.
    "trend": """
      SELECT * REPLACE (floor(momentum * 1e9 + 0.5e0) / 1e9 AS momentum),
        floor(greatest(0e0, least(100e0, slope * 1000e0)) * 1e9 + 0.5e0) / 1e9 AS slope_signal
      FROM (SELECT *, count(*) OVER w AS n,
              CASE WHEN count(*) OVER w >= 2 THEN regr_slope(forecast_attack_prob, rn) OVER w ELSE 0e0 END AS slope,
              (sum(risk_score * rn) OVER w - (min(rn) OVER w - 1) * sum(risk_score) OVER w)
                / (count(*) OVER w * (count(*) OVER w + 1) / 2e0) AS momentum,
              sum(CASE WHEN is_attack THEN 1 ELSE 0 END) OVER w AS suspicious
            FROM (SELECT *, row_number() OVER (PARTITION BY host_id ORDER BY ts, flow_id) AS rn FROM scored)
            WINDOW w AS (PARTITION BY host_id ORDER BY ts, flow_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))""",
    "forecasts": """
      SELECT *, floor(raw * 1e2 + 0.5e0) / 1e2 AS forecast_risk_score,
        CASE WHEN raw >= 80 THEN 'CRITICAL' WHEN raw >= 50 THEN 'HIGH' WHEN raw >= 25 THEN 'MEDIUM'
          ELSE 'LOW' END AS forecast_risk_level,
        CASE WHEN n < 2 THEN 0e0 ELSE floor(n / 8e0 * 1e3 + 0.5e0) / 1e3 END AS forecast_confidence,
        CAST(n AS INTEGER) AS windows_observed
      FROM (SELECT *, CASE WHEN n < 2 THEN 0e0 ELSE floor(greatest(0e0, least(100e0, 0.45e0 * slope_signal
              + 0.35e0 * momentum + 0.20e0 * (suspicious * 100e0 / n))) * 1e9 + 0.5e0) / 1e9 END AS raw FROM trend)""",
}
_ORDER = list(_VIEWS)
_NEEDS = {"flows": [], "cleaned": ["flows"], "classified": ["flows"], "scored": ["flows", "classified"],
          "trend": ["flows", "classified", "scored"],
          "forecasts": ["flows", "classified", "scored", "trend"]}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with the common table expressions it reads."""
    wanted = {v for name in views for v in [*_NEEDS[name], name]}
    ctes = [f"{name} AS ({_VIEWS[name]})" for name in _ORDER if name in wanted]
    sql = sql.strip()
    if sql[:5].upper() == "WITH ":
        return f"WITH {', '.join(ctes)}, {sql[5:]}"
    return f"WITH {', '.join(ctes)} {sql}"


def query(sql: str | None = None, views: str = "flows") -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = with_views(sql, *views.split())
        return fn
    return register


def flows(spark: SparkSession, folder: str) -> DataFrame:
    return flows_of(read_events(spark, folder))


def dirty_flows(spark: SparkSession, folder: str) -> DataFrame:
    return dirty(flows(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return detections(flows(spark, folder))


HOST, ORDER = ["host_id"], ["ts", "flow_id"]


def r6(name: str) -> Column:
    """A sum or mean rounded past the digits that depend on the order of addition."""
    return half_up(F.col(name), 6).alias(name)


def sql6(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5e0) / 1e6"
