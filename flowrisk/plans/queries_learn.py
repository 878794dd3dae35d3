"""Queries that fit a classifier, with the parameters of production.

Trees depend on random draws. What the queries return does not: supports, invariants of
every row, and whether quality reaches a bar. A fit is shared by the queries of a session.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from flowrisk.functions.numeric import half_up
from flowrisk.operators.evaluate import classification_report, fold_f1_summary
from flowrisk.operators.splits import random_split
from flowrisk.plans.model import FlowModel
from flowrisk.plans.queries_prepare import SPLIT_SQL
from flowrisk.plans.registry import HOST, ORDER, flows, query
from flowrisk.plans.scoring import RESULT_COLUMNS
from flowrisk.plans.training import score_files, train, train_baseline, train_encoded, training_metadata
from flowrisk.schema import ALERT_SCORE, BENIGN, CLASSES, LEVELS
from flowrisk.session import shared_path, written
from flowrisk.sources.sinks import export_json, export_split

KEYS = ("flow_id", "host_id", "ts", "k")
GOOD = 0.95  # least accuracy on flows that the forest has not seen

_made: dict[tuple, object] = {}


def _once(spark, folder, what, make):
    key = (spark.sparkContext.applicationId, folder, what)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _split(spark, folder):
    rows = _once(spark, folder, "split", lambda: written(random_split(flows(spark, folder), "flow_id", method="md5"), "split"))
    return rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split")


def _model(spark, folder) -> FlowModel:
    return _once(spark, folder, "model", lambda: FlowModel.fit(_split(spark, folder)[0], exclude=KEYS))


def _run(spark, folder):
    return _once(spark, folder, "run", lambda: train(flows(spark, folder).drop("host_id", "ts", "k"), "label", "flow_id"))


def _judged(report):
    """Entries and supports of a report, and whether its accuracy is good."""
    accuracy = report.filter("entry = 'accuracy'").select("f1_score").scalar()
    return report.select("entry", "support", (accuracy >= GOOD).alias("good"))


def _judged_sql(rows):
    return f"""SELECT label AS entry, count(*) AS support, TRUE AS good FROM ({rows}) GROUP BY 1
      UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), n, TRUE FROM (SELECT count(*) AS n FROM ({rows}))"""


_TEST = f"SELECT flows.* FROM flows JOIN ({SPLIT_SQL}) USING (flow_id) WHERE split = 'test'"


@query(_judged_sql(_TEST))
def rf_train_score(spark, folder):
    """Quality on the 20 % of flows the forest has not seen."""
    scored = _model(spark, folder).score(_split(spark, folder)[1])
    return _judged(classification_report(scored, "label", "predicted_label"))


@query("""SELECT flow_id, TRUE AS sums_to_one, TRUE AS most_probable, TRUE AS sure, TRUE AS risk_fits, TRUE AS level_fits,
            TRUE AS alert_fits, TRUE AS advice_fits FROM flows""")
def rf_batch_scores(spark, folder):
    """All flows scored, and for each whether its eight result columns follow from its probabilities."""
    made = _model(spark, folder).score(flows(spark, folder), probabilities=True)
    p = [F.col(f"p_{c}") for c in CLASSES]
    best, own = F.greatest(*p), reduce(lambda a, b: a + b, [F.when(F.col("predicted_label") == c, x).otherwise(0.0) for c, x in zip(CLASSES, p)])
    risk, benign = F.col("risk_score"), F.col("predicted_label") == BENIGN
    level = reduce(lambda found, bound: F.when(risk >= bound[1], bound[0]).otherwise(found), reversed(LEVELS), F.lit("LOW"))
    advice = F.when(benign, "log").when(F.col("predicted_label") == "PortScan", "log, watch").when(
        F.col("predicted_label") == "BruteForce", "log, watch, contain").otherwise("log, watch, contain, escalate")
    return made.select(
        "flow_id", (F.abs(sum(p[1:], p[0]) - 1) < 1e-9).alias("sums_to_one"), (own == best).alias("most_probable"),
        (F.col("confidence") == half_up(best, 4)).alias("sure"),
        F.when(benign, risk <= 30).otherwise((risk >= 45) & (risk <= 100) & F.col("is_attack")).alias("risk_fits"),
        (F.col("risk_level") == level).alias("level_fits"),
        (F.col("alert_triggered") == (~benign | (risk >= ALERT_SCORE))).alias("alert_fits"),
        (F.col("recommendation") == advice).alias("advice_fits"))


@query("""SELECT flow_id, CAST(least(8, row_number() OVER (PARTITION BY host_id ORDER BY ts, flow_id)) AS INTEGER) AS windows_observed,
            4 AS classes, TRUE AS sums_to_one FROM flows""")
def rf_detections(spark, folder):
    """Scored flows with probability map and nested forecast."""
    made = _model(spark, folder).detect(flows(spark, folder), HOST, ORDER)
    whole = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda s, x: s + x)
    return made.select("flow_id", "forecast.windows_observed", F.size("probabilities").alias("classes"),
                       (F.abs(whole - 1) < 1e-3).alias("sums_to_one"))


@query("SELECT 15 AS features, TRUE AS shares, TRUE AS descending")
def rf_importances(spark, folder):
    made = _model(spark, folder).importances(spark, 15)
    listed = F.collect_list("importance")
    return made.orderBy(F.desc("importance")).agg(listed.alias("v")).select(
        F.size("v").alias("features"), F.forall("v", lambda x: (x >= 0) & (x <= 1)).alias("shares"),
        (F.col("v") == F.reverse(F.array_sort("v"))).alias("descending"))


@query(f"""SELECT 'random forest' AS model_type, '{"+".join(CLASSES)}' AS classes, 16 AS feature_count,
             CAST(round_even(0.8e0 * count(*), 0) AS BIGINT) AS n_samples, 10 AS top_features FROM flows""")
def model_info(spark, folder):
    return _model(spark, folder).model_info(spark).select(
        "model_type", F.array_join("classes", "+").alias("classes"), "feature_count", "n_samples",
        F.size("top_features").alias("top_features"))


@query(f"SELECT count(*) AS flows, 0 AS differing FROM ({_TEST})")
def model_roundtrip(spark, folder):
    """Test flows on which the fitted model and the model read back differ."""
    model, path = _model(spark, folder), shared_path(spark, "model")
    model.save(path)
    both = [m.with_probabilities(_split(spark, folder)[1]).select("flow_id", "predicted_label", F.array(*[f"p_{c}" for c in CLASSES]).alias(n))
            for n, m in (("fitted", model), ("loaded", FlowModel.load(spark, path)))]
    joined = both[0].join(both[1].withColumnRenamed("predicted_label", "again"), "flow_id")
    differs = (F.col("predicted_label") != F.col("again")) | (F.col("fitted") != F.col("loaded"))
    return joined.agg(F.count(F.lit(1)).alias("flows"), F.count_if(differs).cast("int").alias("differing"))


@query("SELECT CAST(5 AS BIGINT) AS cv_folds, TRUE AS good, TRUE AS steady")
def cross_validation(spark, folder):
    """Mean and deviation of the weighted F1 over five folds of 100 trees."""
    return _run(spark, folder).folds.select(
        "cv_folds", (F.col("mean_f1_score") >= GOOD).alias("good"), (F.col("std_f1_score") <= 0.02).alias("steady"))


@query(_judged_sql("SELECT * FROM flows"))
def cross_validation_report(spark, folder):
    """Pooled report: every flow predicted once, by the forest that has not seen it."""
    return _judged(_run(spark, folder).report)


@query("""SELECT n - t AS test_rows, t AS train_rows, n AS n_samples, CAST(5 AS BIGINT) AS cv_folds, 7 AS report_entries,
            15 AS top_features FROM (SELECT count(*) AS n, CAST(round_even(0.8e0 * count(*), 0) AS BIGINT) AS t FROM flows)""")
def training_run(spark, folder):
    """The whole run, exported and read back: split, metadata and report."""
    run, out = _run(spark, folder), shared_path(spark, "run")
    export_split(run.split, f"{out}/split", "csv")
    export_json(training_metadata(spark, run), f"{out}/metadata")
    rows = [spark.read.option("header", "true").csv(f"{out}/split/split={part}").agg(F.count(F.lit(1)).alias(f"{part}_rows"))
            for part in ("test", "train")]
    found = spark.read.json(f"{out}/metadata").select(
        "n_samples", F.col("cross_validation.cv_folds").alias("cv_folds"),
        F.size("classification_report").alias("report_entries"), F.size("top_features").alias("top_features"))
    return found.select(rows[0].scalar().alias("test_rows"), rows[1].scalar().alias("train_rows"), "*")


@query(f"SELECT flow_id, {len(RESULT_COLUMNS)} AS result_columns, TRUE AS scored FROM flows")
def score_file(spark, folder):
    """From files to files: CSV in, all of it scored, CSV out, read back."""
    source, out = shared_path(spark, "captures"), shared_path(spark, "scored")
    flows(spark, folder).drop("label", "ts").write.option("header", "true").csv(source)
    score_files(_model(spark, folder), source, out)
    back = spark.read.option("header", "true").csv(out)
    there = sum((F.col(c).isNotNull().cast("int") for c in RESULT_COLUMNS), F.lit(0))
    return back.select(F.col("flow_id").cast("long"), there.alias("result_columns"),
                       (F.col("risk_score").cast("double") >= 0).alias("scored"))


_BASELINE = """SELECT label FROM (SELECT label, row_number() OVER (PARTITION BY label ORDER BY flow_id) AS rn,
    count(*) OVER (PARTITION BY label) AS n FROM flows) WHERE n >= 50 AND rn > ceil(0.75e0 * n)"""


@query(_judged_sql(_BASELINE))
def baseline_forest(spark, folder):
    rows = flows(spark, folder).drop("host_id", "ts", "k")
    tested = _once(spark, folder, "baseline", lambda: train_baseline(rows, "flow_id"))[1]
    return _judged(classification_report(tested, "truth", "predicted"))


@query("SELECT 'accuracy' AS entry, n - CAST(round_even(0.8e0 * n, 0) AS BIGINT) AS support, TRUE AS good FROM (SELECT count(*) AS n FROM flows)")
def encoded_forest(spark, folder):
    """A forest over label-encoded text and a few numbers."""
    rows = flows(spark, folder).withColumn("host", F.concat(F.lit("h"), F.col("host_id").cast("string")))
    names = ["host", "protocol_type", "dst_port", "duration", "packet_rate", "unique_dst_ports", "failed_logins"]
    tested = _once(spark, folder, "encoded", lambda: train_encoded(rows, "flow_id", "label", ["host", "protocol_type"], names))[1]
    return _judged(classification_report(tested, "truth", "predicted")).filter("entry = 'accuracy'")
