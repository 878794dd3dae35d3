import pytest
from pyspark.sql import functions as F

from flowrisk.plans.scoring import add_risk, add_risk_from_map

# label, probabilities, attack probability, score, level, alert
ANCHORS = [
    ("Normal", {"Normal": 0.92}, 0.08, 2.40, "LOW", False),
    ("Normal", {"Normal": 0.10}, 0.90, 27.00, "MEDIUM", False),
    ("PortScan", {"PortScan": 1.0, "Normal": 0.0}, 1.0, 75.50, "HIGH", True),
    ("PortScan", {"PortScan": 0.10, "Normal": 0.05}, 0.95, 48.50, "MEDIUM", True),
    ("BruteForce", {"BruteForce": 0.80, "Normal": 0.20}, 0.80, 83.50, "CRITICAL", True),
    ("DoS", {"DoS": 0.50, "Normal": 0.10}, 0.90, 78.00, "HIGH", True),
    ("DoS", {"DoS": 1.0, "Normal": 0.0}, 1.0, 93.00, "CRITICAL", True),
    ("U2R", {"U2R": 1.0, "Normal": 0.0}, 1.0, 98.60, "CRITICAL", True),
    ("Worm", {"Worm": 0.40, "Normal": 0.60}, 0.40, 61.00, "HIGH", True),
    ("DoS", {"DoS": 0.60}, 0.60, 81.00, "CRITICAL", True),
    ("DoS", {"PortScan": 0.3}, 1.0, 93.00, "CRITICAL", True),
    ("Normal", {"DoS": 0.3}, 1.0, 30.00, "MEDIUM", False),
    ("Normal", {}, 1.0, 30.00, "MEDIUM", False),
]


def test_anchors(spark):
    rows = [(i, label, p) for i, (label, p, *_) in enumerate(ANCHORS)]
    df = spark.createDataFrame(rows, "i int, predicted_label string, probabilities map<string,double>")
    got = {r["i"]: r for r in add_risk_from_map(df).collect()}
    for i, (label, _, attack, score, level, alert) in enumerate(ANCHORS):
        r = got[i]
        assert (r["attack_probability"], r["risk_score"], r["risk_level"], r["alert_triggered"]) == (
            pytest.approx(attack, abs=1e-9), pytest.approx(score, abs=1e-9), level, alert), label
    advice = {r["predicted_label"]: r["recommendation"] for r in got.values()}
    assert len({advice["Worm"], advice["DoS"], advice["Normal"]}) == 3


def test_unlisted_classes_share_the_general_advice(spark):
    df = spark.createDataFrame([(c, {"Normal": 0.1}) for c in ("Worm", "R2L", "Botnet", "Other")],
                               "predicted_label string, probabilities map<string,double>")
    assert add_risk_from_map(df).select("recommendation").distinct().count() == 1


def test_alert_equals_attack_and_portscan_is_never_critical(spark):
    grid = spark.range(101).select((F.col("id") / 100).alias("p"))
    rows = None
    for label in ("BruteForce", "DoS", "Normal", "PortScan"):
        df = grid.select(
            F.lit(label).alias("predicted_label"),
            *[(F.col("p") if c == label else (1 - F.col("p")) / 3).alias(f"p_{c}")
              for c in ("BruteForce", "DoS", "Normal", "PortScan")])
        rows = df if rows is None else rows.unionByName(df)
    scored = add_risk(rows)
    assert scored.filter(F.col("alert_triggered") != F.col("is_attack")).count() == 0
    assert scored.filter("predicted_label = 'PortScan' and risk_level = 'CRITICAL'").count() == 0
    assert scored.filter("risk_score < 0 or risk_score > 100").count() == 0


def test_one_class_model_without_a_benign_class(spark):
    df = spark.createDataFrame([("DoS", 0.6)], "predicted_label string, p_DoS double")
    row = add_risk(df, ["DoS"]).first()
    assert (row["attack_probability"], row["risk_score"]) == (0.6, 81.0)
