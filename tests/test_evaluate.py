import numpy as np
import pytest
from pyspark.sql import functions as F

from flowrisk.operators import evaluate, explore, report

# Pooled out-of-fold counts and the published figures they must give.
PAIRS = [("BruteForce", "BruteForce", 1200), ("DoS", "DoS", 1500), ("Normal", "Normal", 5998),
         ("Normal", "BruteForce", 2), ("PortScan", "PortScan", 1500)]
PUBLISHED = {
    "BruteForce": (0.9983361064891847, 1.0, 0.9991673605328892, 1200),
    "DoS": (1.0, 1.0, 1.0, 1500),
    "Normal": (1.0, 0.9996666666666667, 0.9998333055509252, 6000),
    "PortScan": (1.0, 1.0, 1.0, 1500),
    "accuracy": (0.9998039215686274,) * 3 + (10200,),
    "macro avg": (0.9995840266222962, 0.9999166666666667, 0.9997501665209536, 10200),
    "weighted avg": (0.999804247822257, 0.9998039215686274, 0.9998039868573548, 10200),
}


def expand(spark, pairs):
    df = spark.createDataFrame(pairs, "truth string, predicted string, n int")
    return df.select("truth", "predicted", F.explode(F.sequence(F.lit(1), "n")).alias("i"))


def test_published_report(spark):
    got = {r["entry"]: tuple(r)[1:] for r in evaluate.classification_report(expand(spark, PAIRS), "truth", "predicted").collect()}
    assert set(got) == set(PUBLISHED)
    for entry, figures in PUBLISHED.items():
        assert got[entry] == pytest.approx(figures, abs=1e-12), entry


def test_zero_division(spark):
    made = evaluate.class_scores(expand(spark, [("a", "b", 3), ("b", "b", 1)]), "truth", "predicted")
    got = {r["class"]: (r["precision"], r["recall"], r["f1_score"], r["support"]) for r in made.collect()}
    assert got == {"a": (0.0, 0.0, 0.0, 3), "b": (0.25, 1.0, 0.4, 1)}


def test_confusion_matrix(spark):
    made = evaluate.confusion_matrix(expand(spark, PAIRS), "truth", "predicted")
    assert made.columns == ["truth", "pred_BruteForce", "pred_DoS", "pred_Normal", "pred_PortScan"]
    assert {tuple(r) for r in made.collect()} >= {("Normal", 2, 0, 5998, 0)}
    wider = evaluate.confusion_matrix(expand(spark, PAIRS[:1]), "truth", "predicted", ["BruteForce", "U2R"])
    assert {tuple(r) for r in wider.collect()} == {("BruteForce", 1200, 0), ("U2R", 0, 0)}


def test_fold_summary(spark):
    df = expand(spark, PAIRS).withColumn("fold", F.col("i") % 5)
    folds = [r["weighted_f1"] for r in evaluate.fold_f1(df, "fold", "truth", "predicted").collect()]
    row = evaluate.fold_f1_summary(df, "fold", "truth", "predicted").first()
    assert row["cv_folds"] == 5
    assert row["mean_f1_score"] == pytest.approx(np.mean(folds), abs=1e-12)
    assert row["std_f1_score"] == pytest.approx(np.std(folds), abs=1e-12)


def test_correlation_skips_missing_pairs(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1, (300, 3))
    x[:, 2] += x[:, 0]
    rows = [tuple(None if rng.random() < .1 else float(v) for v in r) + (7.0,) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["a"], r["b"]): r["r"] for r in explore.correlation(df).collect()}
    assert len(got) == 6 and got["d", "a"] is None
    for i, j in ((1, 0), (2, 0), (2, 1)):
        both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        assert got["abcd"[i], "abcd"[j]] == pytest.approx(np.corrcoef(np.array(both).T)[0, 1], abs=1e-9)


def test_histograms(spark):
    values = [0.0, 1.0, 1.0, 2.5, 10.0, None]
    df = spark.createDataFrame([(v, "a") for v in values], "v double, label string")
    got = sorted(map(tuple, explore.histogram(df, "v", 4).collect()))
    assert [r[3] for r in got] == list(np.histogram([v for v in values if v is not None], 4)[0])
    one = explore.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 4)
    assert sum(r["n"] for r in one.collect()) == 2
    clipped = explore.clipped_histograms(df, ["v"], "label", 4, 0.75)
    counts, _ = np.histogram(np.minimum([0, 1, 1, 2.5, 10], 2.5), 4, density=True)
    dense = dict.fromkeys(range(4), 0.0) | {r["bin"]: r["density"] for r in clipped.collect()}
    assert [dense[i] for i in range(4)] == pytest.approx(list(counts))


def test_small_reports(spark):
    df = spark.createDataFrame([("a",)] * 60 + [("b",)] * 49 + [(None,)], "label string")
    assert {r["label"] for r in explore.drop_rare_classes(df, "label").collect()} == {"a"}
    assert [(r["label"], r["n"]) for r in explore.distribution(df, "label").collect()] == [("a", 60), ("b", 49), (None, 1)]
    weights = {r["label"]: r["weight"] for r in explore.class_weights(df, "label").collect()}
    assert weights == {"a": 109 / 120, "b": 109 / 98}
    profile = {r["column"]: r for r in explore.column_profile(df).collect()}
    assert (profile["label"]["nulls"], profile["label"]["approx_distinct"]) == (1, 2)
    assert explore.kinds(df).collect() == [("string", 1)]
    encoded = explore.label_encode(df, "label", "code").select("label", "code").distinct()
    assert {tuple(r) for r in encoded.collect()} == {("a", 0), ("b", 1), (None, None)}


def test_correlation_takes_all_given_columns(spark):
    df = spark.range(50).select(*[(F.col("id") * (j + 3) % 17).cast("double").alias(f"c.{j}") for j in range(22)])
    assert explore.correlation(df, df.columns).count() == 231
    assert explore.correlation(df).count() == 190


def test_incident_report_of_flows_without_label(spark, capsys):
    rows = [(1, "DoS", 70.0), (2, None, 0.0), (3, "Normal", 1.0)]
    df = spark.createDataFrame(rows, "ts int, predicted_label string, risk_score double")
    made = report.incident_report(df, ["ts"], ["ts", "predicted_label"])
    row = made.first()
    assert (row["flows_evaluated"], row["threats"], row["status"], row["class_counts"]) == (3, 1, "severe", {"DoS": 1, "Normal": 1})
    assert row["last_flow"]["ts"] == 3 and [t["ts"] for t in row["last_threats"]] == [1]
    made.explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_label_encoding_of_many_values(spark, monkeypatch):
    monkeypatch.setattr("flowrisk.operators.explore.small_rows", lambda df: None)
    df = spark.range(500).select(F.concat(F.lit("v"), F.col("id") % 120).alias("v"))
    got = {tuple(r) for r in explore.label_encode(df, "v", "code").distinct().collect()}
    assert got == {(v, i) for i, v in enumerate(sorted(f"v{i}" for i in range(120)))}


@pytest.mark.parametrize("labels, expected", [
    (["Normal"], "none"), (["DoS", "Normal", "DoS"], "DoS"), (["DoS", "PortScan"], "multiple")])
def test_threat_summary(spark, labels, expected):
    df = spark.createDataFrame([(c,) for c in labels], "predicted_label string")
    assert report.threat_summary(df).first()["attack"] == expected
