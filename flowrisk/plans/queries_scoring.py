"""Queries on risk scores, alerts, reports and feeds."""

from pyspark.sql import functions as F

from flowrisk.functions import risk
from flowrisk.operators import clean, report
from flowrisk.operators.rolling import latest_rows
from flowrisk.plans.registry import HOST, ORDER, flows, query, r6, scored, sql6
from flowrisk.plans.scoring import RESULT_COLUMNS, add_risk_from_map, class_columns, probability_map
from flowrisk.schema import CLASSES, SEVERITY
from flowrisk.sources.event_flows import classified

_ADVICE = """CASE predicted_label WHEN 'Normal' THEN 'log' WHEN 'PortScan' THEN 'log, watch' WHEN 'BruteForce' THEN 'log, watch, contain'
    WHEN 'DoS' THEN 'log, watch, contain, escalate' WHEN 'DDoS' THEN 'log, watch, contain, escalate'
    WHEN 'U2R' THEN 'log, watch, contain, escalate' ELSE 'log, watch' END AS recommendation"""
_RESULTS = f"""predicted_label, is_attack, confidence, attack_probability, risk_score, risk_level,
  is_attack OR risk_score >= 35 AS alert_triggered, {_ADVICE}"""


@query("SELECT predicted_label, risk_level, count(*) AS flows FROM scored GROUP BY 1, 2", "scored")
def risk_levels(spark, folder):
    return scored(spark, folder).groupBy("predicted_label", "risk_level").agg(F.count(F.lit(1)).alias("flows"))


@query(f"SELECT flow_id, {_RESULTS} FROM scored", "scored")
def risk_scores(spark, folder):
    return scored(spark, folder).select("flow_id", *RESULT_COLUMNS)


_INPUT = """flow_id, host_id, ts, duration, src_bytes, dst_bytes, packet_rate, connections_to_same_host,
  unique_dst_ports, failed_logins, dst_port, protocol_type, label"""


@query(f"SELECT {_INPUT}, {_RESULTS} FROM scored", "scored")
def batch_scores(spark, folder):
    rows = flows(spark, folder)
    given = [c for c in rows.columns if c != "k"]
    return scored(spark, folder).select(*given, *RESULT_COLUMNS)


def _odd_maps(spark, folder):
    """Labels inside and outside the severity table over maps with missing keys."""
    rows = classified(flows(spark, folder))
    names = F.array(*map(F.lit, ["DDoS", "U2R", "R2L", "Botnet", "Other", "Worm"]))
    label = F.when(F.col("flow_id") % 4 == 0, F.element_at(names, (F.col("k") % 6 + 1).cast("int")))
    rows = rows.withColumn("predicted_label", F.coalesce(label, F.col("predicted_label")))
    kept = F.map_filter(probability_map(CLASSES), lambda name, _: ~(
        ((name == "Normal") & (F.col("flow_id") % 7 == 0))
        | ((name == F.col("predicted_label")) & (F.col("flow_id") % 11 == 0))))
    return rows.select("flow_id", "predicted_label", kept.alias("probabilities"))


_SEVERITIES = " ".join(f"WHEN '{c}' THEN {v}e0" for c, v in SEVERITY.items())


@query(f"""
  SELECT flow_id, predicted_label, floor(attack * 1e4 + 0.5e0) / 1e4 AS attack_probability, confidence, risk_score,
    CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
         WHEN risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
    predicted_label <> 'Normal' OR risk_score >= 35 AS alert_triggered, {_ADVICE}
  FROM (SELECT *, floor(CASE predicted_label WHEN 'Normal' THEN greatest(0e0, (1e0 - coalesce(pn, 0e0)) * 30e0)
      ELSE least(100e0, greatest(0e0, CASE predicted_label {_SEVERITIES} ELSE 0.7e0 END * 70e0
        + coalesce(pl, attack) * 30e0)) END * 1e2 + 0.5e0) / 1e2 AS risk_score
    FROM (SELECT *, CASE WHEN pn IS NOT NULL THEN 1e0 - pn WHEN predicted_label = 'Normal' THEN 1e0 - coalesce(pl, 0e0)
        ELSE coalesce(pl, 1e0) END AS attack
      FROM (SELECT flow_id, predicted_label, pn, CASE predicted_label WHEN 'BruteForce' THEN pb WHEN 'DoS' THEN pd
          WHEN 'Normal' THEN pn WHEN 'PortScan' THEN pp END AS pl, greatest(pb, pd, pn, pp) AS confidence
        FROM (SELECT flow_id, predicted_label,
            CASE WHEN predicted_label = 'BruteForce' AND flow_id % 11 = 0 THEN NULL ELSE floor(p_b * 1e4 + 0.5e0) / 1e4 END AS pb,
            CASE WHEN predicted_label = 'DoS' AND flow_id % 11 = 0 THEN NULL ELSE floor(p_d * 1e4 + 0.5e0) / 1e4 END AS pd,
            CASE WHEN flow_id % 7 = 0 OR (predicted_label = 'Normal' AND flow_id % 11 = 0) THEN NULL
              ELSE floor(p_n * 1e4 + 0.5e0) / 1e4 END AS pn,
            CASE WHEN predicted_label = 'PortScan' AND flow_id % 11 = 0 THEN NULL ELSE floor(p_p * 1e4 + 0.5e0) / 1e4 END AS pp
          FROM (SELECT * REPLACE (CASE WHEN flow_id % 4 <> 0 THEN predicted_label
              ELSE CASE k % 6 WHEN 0 THEN 'DDoS' WHEN 1 THEN 'U2R' WHEN 2 THEN 'R2L' WHEN 3 THEN 'Botnet'
                WHEN 4 THEN 'Other' ELSE 'Worm' END END AS predicted_label) FROM classified)))))""", "classified")
def risk_map_lookup(spark, folder):
    return add_risk_from_map(_odd_maps(spark, folder)).select(
        "flow_id", "predicted_label", "attack_probability", "confidence", "risk_score", "risk_level", "alert_triggered",
        "recommendation")


@query("""SELECT flow_id, floor(p_b * 1e4 + 0.5e0) / 1e4 AS brute_force, floor(p_d * 1e4 + 0.5e0) / 1e4 AS dos,
            floor(p_n * 1e4 + 0.5e0) / 1e4 AS normal, floor(p_p * 1e4 + 0.5e0) / 1e4 AS port_scan FROM classified""",
       "classified")
def probability_maps(spark, folder):
    p = probability_map(CLASSES)
    return scored(spark, folder).select("flow_id", p["BruteForce"].alias("brute_force"), p["DoS"].alias("dos"),
                                        p["Normal"].alias("normal"), p["PortScan"].alias("port_scan"))


@query("""SELECT flow_id, is_attack AND (CAST(p_d >= 0.2e0 AS INTEGER) + CAST(p_p >= 0.2e0 AS INTEGER)
            + CAST(p_b >= 0.2e0 AS INTEGER)) > 1 AS concurrent_attack FROM scored""", "scored")
def concurrent_attacks(spark, folder):
    flag = risk.concurrent_attack(F.col("predicted_label"), class_columns(CLASSES))
    return scored(spark, folder).select("flow_id", flag.alias("concurrent_attack"))


@query("""SELECT count(*) AS flows, count(*) FILTER (is_attack) AS threats,
            CASE count(DISTINCT predicted_label) FILTER (is_attack) WHEN 0 THEN 'none'
              WHEN 1 THEN min(predicted_label) FILTER (is_attack) ELSE 'multiple' END AS attack
          FROM scored""", "scored")
def threat_summary(spark, folder):
    return report.threat_summary(scored(spark, folder))


@query(f"""SELECT coalesce(predicted_label, 'all') AS predicted_label, count(*) AS flows,
            count(*) FILTER (NOT is_attack) AS safe, count(*) FILTER (is_attack) AS threats,
            {sql6("100e0 * count(*) FILTER (NOT is_attack) / count(*)")} AS safe_percent,
            {sql6("100e0 * count(*) FILTER (is_attack) / count(*)")} AS threat_percent
          FROM scored GROUP BY ROLLUP (predicted_label)""", "scored")
def kpi_rollup(spark, folder):
    return report.kpis(scored(spark, folder)).withColumns(
        {c: r6(c) for c in ("safe_percent", "threat_percent")})


@query("""SELECT date_trunc('hour', ts) AS hour, CASE WHEN bool_or(is_attack) THEN 'severe' ELSE 'secure' END AS posture,
            count(*) FILTER (is_attack) AS threats, count(*) AS flows FROM scored GROUP BY 1""", "scored")
def posture_by_hour(spark, folder):
    hour = F.window("ts", "1 hour")["start"].alias("hour")
    return report.posture(scored(spark, folder).select(hour, "predicted_label"), ["hour"])


@query("""SELECT host_id, CASE WHEN bool_or(is_attack) THEN 'severe' ELSE 'secure' END AS posture,
            count(*) FILTER (is_attack) AS threats, count(*) AS flows FROM scored GROUP BY 1""", "scored")
def posture_by_host(spark, folder):
    return report.posture(scored(spark, folder), HOST)


_FEED = ["flow_id", "host_id", "ts", "dst_port", "predicted_label", "risk_score"]


@query(f"SELECT {', '.join(_FEED)} FROM scored ORDER BY ts DESC, flow_id DESC LIMIT 20", "scored")
def latest_20(spark, folder):
    return latest_rows(scored(spark, folder), [], ORDER, 20).select(*_FEED)


@query(f"""SELECT {', '.join(_FEED)} FROM (SELECT *, row_number() OVER (PARTITION BY host_id
             ORDER BY ts DESC, flow_id DESC) AS rn FROM scored) WHERE rn <= 20""", "scored")
def latest_20_per_host(spark, folder):
    return latest_rows(scored(spark, folder).select(*_FEED), HOST, ORDER, 20)


@query(f"SELECT {', '.join(_FEED)} FROM scored WHERE is_attack ORDER BY ts DESC, flow_id DESC LIMIT 15", "scored")
def latest_threats(spark, folder):
    return report.latest_threats(scored(spark, folder), ORDER).select(*_FEED)


@query("""SELECT max(ts) AS reported_at, CASE WHEN bool_or(is_attack) THEN 'severe' ELSE 'secure' END AS status,
    count(*) AS flows_evaluated, count(*) FILTER (is_attack) AS threats, arg_max(flow_id, ts) AS last_flow_id,
    (SELECT string_agg(predicted_label || '=' || n, ',' ORDER BY predicted_label)
       FROM (SELECT predicted_label, count(*) AS n FROM scored GROUP BY 1)) AS class_counts,
    (SELECT string_agg(CAST(flow_id AS VARCHAR), ',' ORDER BY ts DESC, flow_id DESC)
       FROM (SELECT * FROM scored WHERE is_attack ORDER BY ts DESC, flow_id DESC LIMIT 15)) AS last_threat_ids
  FROM scored""", "scored")
def incident_report(spark, folder):
    made = report.incident_report(scored(spark, folder), ORDER, _FEED)
    counts = F.transform(F.map_entries("class_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    ids = F.transform("last_threats", lambda t: t["flow_id"].cast("string"))
    return made.select("reported_at", "status", "flows_evaluated", "threats",
                       F.col("last_flow.flow_id").alias("last_flow_id"),
                       F.array_join(counts, ",").alias("class_counts"), F.array_join(ids, ",").alias("last_threat_ids"))


@query("""SELECT flow_id, dst_port, protocol_type, predicted_label FROM scored
          WHERE contains(CAST(dst_port AS VARCHAR), '80') OR contains(lower(protocol_type), '80')
             OR contains(lower(predicted_label), '80')""", "scored")
def flow_search(spark, folder):
    found = clean.search(scored(spark, folder), "80", ["dst_port", "protocol_type", "predicted_label"])
    return found.select("flow_id", "dst_port", "protocol_type", "predicted_label")


@query("""SELECT flow_id, kind FROM (
            SELECT flow_id, 'threats' AS kind FROM scored WHERE is_attack
            UNION ALL SELECT flow_id, 'safe' FROM scored WHERE NOT is_attack
            UNION ALL SELECT flow_id, 'DoS' FROM scored WHERE predicted_label = 'DoS')""", "scored")
def class_filter(spark, folder):
    rows = scored(spark, folder)
    parts = [clean.traffic_filter(rows, kind).select("flow_id", F.lit(kind).alias("kind"))
             for kind in ("threats", "safe", "DoS")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""SELECT {_INPUT}, (SELECT count(*) FROM flows) AS total_rows FROM flows ORDER BY flow_id LIMIT 25""")
def dataset_head(spark, folder):
    return report.dataset_head(flows(spark, folder).drop("k"), "flow_id")
