"""Quality bars on the adapter's labels, which are a fixed function of the features."""

import threading

import pytest
from pyspark.sql import functions as F

from flowrisk.operators.evaluate import class_scores, fold_f1_summary
from flowrisk.operators.splits import random_split, stratified_folds
from flowrisk.plans.model import FlowModel, ForestParams
from flowrisk.plans import queries_learn
from flowrisk.plans.queries_learn import KEYS
from flowrisk.plans.registry import HOST, ORDER, dirty_flows, flows
from flowrisk.plans.scoring import RESULT_COLUMNS
from flowrisk.plans.training import cross_validate, score_files, train_baseline, train_encoded, training_metadata, TrainingRun
from flowrisk.schema import CLASSES, MODEL_FEATURES
from flowrisk.sources.sinks import export_json, export_predictions, export_split

FOLDER = "/root/testdata/sf0.01"
SMALL = ForestParams(trees=20, depth=8, max_bins=32)  # the queries run the full parameters


@pytest.fixture(scope="module")
def split(spark):
    rows = random_split(flows(spark, FOLDER), "flow_id")
    return rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split")


@pytest.fixture(scope="module")
def model(split):
    return FlowModel.fit(split[0], params=SMALL, exclude=KEYS)


def accuracy(df, truth="label", predicted="predicted_label"):
    return df.agg(F.avg((F.col(truth) == F.col(predicted)).cast("int"))).first()[0]


def test_quality_and_columns(model, split):
    scored = model.score(split[1])
    assert scored.columns == [*split[1].columns, "predicted_label", *[c for c in scored.columns if c in RESULT_COLUMNS[1:]]]
    assert set(RESULT_COLUMNS) <= set(scored.columns)
    assert accuracy(scored) >= 0.95
    assert model.classes == CLASSES
    assert sorted(model.stats.feature_names) == sorted(MODEL_FEATURES)
    assert scored.filter("predicted_label = 'Normal' and risk_level != 'LOW'").count() == 0


def test_input_goes_through_untouched(spark, model):
    raw = dirty_flows(spark, FOLDER).limit(500)
    scored = model.score(raw)
    assert scored.select(raw.columns).exceptAll(raw).count() == 0
    assert scored.filter("predicted_label is null or risk_score is null").count() == 0


def test_missing_columns_and_clashing_names(spark, model):
    few = spark.createDataFrame([(1, 5.0, "mine")], "flow_id int, packet_rate double, risk_level string")
    row = model.score(few).first()
    assert row["packet_rate"] == 5.0 and row["risk_level"] in ("LOW", "MEDIUM", "HIGH", "CRITICAL")
    assert model.score(few.limit(0)).count() == 0
    one = model.score_records(spark, {"duration": 2.1, "packet_rate": 620.0, "dst_port": 80})
    assert one.count() == 1


def test_probabilities_sum_to_one(model, split):
    p = model.with_probabilities(split[1])
    total = sum((F.col(f"p_{c}") for c in CLASSES[1:]), F.col(f"p_{CLASSES[0]}"))
    assert p.filter(F.abs(total - 1) > 1e-9).count() == 0


def test_scoring_does_not_shuffle(model, split, spark, capsys):
    model.score(flows(spark, FOLDER)).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_condition_on_inputs_reaches_the_scan(model, spark, capsys):
    rows = spark.read.parquet(f"{FOLDER}/events.parquet").withColumn("packet_rate", F.col("value") * 8)
    model.score(rows, where="event_id = 5").explain("formatted")
    assert "EqualTo(event_id,5)" in capsys.readouterr().out
    made = model.score(rows, where="event_id < 5")
    assert made.count() == 5 and set(rows.columns) <= set(made.columns)


def test_files_are_scored_whole(model, spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries_learn, "_model", lambda *_: model)
    monkeypatch.setattr(queries_learn, "shared_path", lambda _, purpose: str(tmp_path / purpose))
    folder = "/root/testdata/sf0.001"
    queries_learn.score_file(spark, folder)
    back = spark.read.option("header", "true").csv(str(tmp_path / "scored"))
    want = flows(spark, folder).select(F.col("flow_id").cast("string"))
    assert back.count() == want.count() and want.exceptAll(back.select("flow_id")).count() == 0
    assert back.filter("risk_score is null or cast(risk_score as double) < 0").count() == 0


def test_files_are_scored_under_a_condition(model, spark, tmp_path):
    flows(spark, FOLDER).filter("flow_id < 50").write.option("header", "true").csv(str(tmp_path / "in"))
    score_files(model, str(tmp_path / "in"), str(tmp_path / "out"), where="flow_id % 4 = 0")
    back = spark.read.option("header", "true").csv(str(tmp_path / "out"))
    want = flows(spark, FOLDER).filter("flow_id < 50 and flow_id % 4 = 0").select(F.col("flow_id").cast("string"))
    assert sorted(back.select("flow_id").collect()) == sorted(want.collect())


def test_unreadable_model_is_no_missing_model(spark, tmp_path):
    (tmp_path / "model" / "model").mkdir(parents=True)
    with pytest.raises(Exception) as e:
        FlowModel.load(spark, str(tmp_path / "model"))
    assert not isinstance(e.value, FileNotFoundError)


def test_detect_carries_map_and_forecast(model, split):
    made = model.detect(split[1], HOST, ORDER)
    row = made.orderBy(F.desc("ts")).first()
    assert set(row["probabilities"]) == set(CLASSES)
    assert row["forecast"]["windows_observed"] >= 1
    assert made.count() == split[1].count()


def test_save_and_load(spark, model, split, tmp_path):
    path = str(tmp_path / "model")
    model.save(path)
    for again in (FlowModel.load(spark, path), FlowModel.load(spark, "model", fallback=str(tmp_path))):
        assert again.stats == model.stats and again.info == model.info
        a = model.score(split[1]).select("flow_id", "predicted_label", "risk_score")
        assert a.exceptAll(again.score(split[1]).select(a.columns)).count() == 0
    with pytest.raises(FileNotFoundError):
        FlowModel.load(spark, str(tmp_path / "none"))


def test_importances(spark, model):
    rows = model.importances(spark, 5).collect()
    assert len(rows) == 5
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)
    assert model.importances(spark, 100).count() == 16


def test_cross_validation_uses_each_flow_once(spark):
    rows = flows(spark, FOLDER).drop("host_id", "ts", "k")
    made = cross_validate(rows, "label", "flow_id", 2, ForestParams(trees=5, depth=6, max_bins=32)).persist()
    assert made.count() == rows.count() == made.select("flow_id").distinct().count()
    folds = stratified_folds(rows, "label", "flow_id", 2).select("flow_id", "fold")
    assert made.select("flow_id", "fold").exceptAll(folds).count() == 0
    summary = fold_f1_summary(made, "fold", "truth", "predicted")
    assert summary.first()["mean_f1_score"] >= 0.9


def test_metadata_export(spark, model, split, tmp_path):
    pairs = model.score(split[1]).select(F.col("label").alias("truth"), F.col("predicted_label").alias("predicted"),
                                         (F.col("flow_id") % 2).alias("fold"))
    from flowrisk.operators.evaluate import classification_report
    run = TrainingRun(model, None, fold_f1_summary(pairs, "fold", "truth", "predicted"),
                      classification_report(pairs, "truth", "predicted"), split[1])
    made = training_metadata(spark, run, "7")
    export_json(made, str(tmp_path / "meta"))
    row = spark.read.json(str(tmp_path / "meta")).first()
    assert row["model_version"] == "7" and row["n_samples"] == split[0].count()
    assert len(row["top_features"]) == 15 and row["cross_validation"]["cv_folds"] == 2
    assert [e["entry"] for e in row["classification_report"]] == sorted([*CLASSES, "accuracy", "macro avg", "weighted avg"])


def test_exports(spark, model, split, tmp_path):
    rows = random_split(flows(spark, FOLDER), "flow_id")
    export_split(rows, str(tmp_path / "split"), "csv")
    for part, n in (("train", 8000), ("test", 2000)):
        assert spark.read.option("header", "true").csv(str(tmp_path / "split" / f"split={part}")).count() == n
    detected = model.detect(split[1], HOST, ORDER)
    export_predictions(detected, str(tmp_path / "scored"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "scored"))
    assert back.count() == 2000 and back.columns == detected.columns


def test_baseline(spark):
    rows = flows(spark, FOLDER).drop("host_id", "ts", "k")
    model, tested = train_baseline(rows, "flow_id", SMALL)
    assert accuracy(tested, "truth", "predicted") >= 0.95
    assert "protocol_type" not in " ".join(model.stats.feature_names)
    assert not model.derive
    _, sampled = train_baseline(rows, "flow_id", SMALL, sample=2000)
    assert 480 <= sampled.count() <= 500


def test_encoded(spark):
    rows = flows(spark, FOLDER)
    model, tested = train_encoded(rows, "flow_id", "label", ["protocol_type"],
                                  ["protocol_type", "packet_rate", "unique_dst_ports", "failed_logins"], SMALL)
    assert model.stats.feature_names[0] == "protocol_type_code"
    recall = class_scores(tested, "truth", "predicted").filter("class = 'DoS'").first()["recall"]
    assert recall >= 0.9


def test_unlabelled_training_data(spark):
    with pytest.raises(ValueError):
        FlowModel.fit(spark.range(3))


def test_training_rows_lie_on_all_cores(spark, split, monkeypatch):
    from flowrisk.plans import model as module
    cores, seen = spark.sparkContext.defaultParallelism, []
    learner = ForestParams.classifier

    def watched(params, *rows):
        made = learner(params, *rows)
        fit = made.fit
        made.fit = lambda df: (seen.append((df.rdd.getNumPartitions(), made.getCacheNodeIds())), fit(df))[1]
        return made

    monkeypatch.setattr(ForestParams, "classifier", watched)
    few = ForestParams(trees=4, depth=6, max_bins=16)
    kept = FlowModel.fit(split[0].coalesce(1), params=few, exclude=KEYS)
    monkeypatch.setattr(module, "CACHED_IDS", 100)
    monkeypatch.setattr(module, "PART_ROWS", 600)
    sought = FlowModel.fit(split[0].coalesce(1), params=few, exclude=KEYS)
    assert seen == [(cores, True), (2 * cores, False)]
    assert kept.info["n_samples"] == sought.info["n_samples"] == 8000


def test_kept_node_ids_give_the_same_forest(spark, split):
    few = ForestParams(trees=6, depth=12)
    rows = few.classifier(10**12).getCacheNodeIds(), few.classifier(10).getCacheNodeIds()
    assert rows == (False, True)
    import flowrisk.plans.model as module
    made = []
    for bound in (0, 10**9):
        module.CACHED_IDS, before = bound, module.CACHED_IDS
        try:
            made.append(FlowModel.fit(split[0], params=few, exclude=KEYS).forest.toDebugString.split("\n", 1)[1])
        finally:
            module.CACHED_IDS = before
    assert made[0] == made[1]


def test_training_rows_are_derived_once(spark, split):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x

    rows = split[0].filter("flow_id < 500").withColumn("packet_rate", counted("packet_rate"))
    FlowModel.fit(rows, params=ForestParams(trees=2, depth=3, max_bins=16), exclude=KEYS)
    n = split[0].filter("flow_id < 500").count()
    assert n <= seen.value <= 2 * n


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    from flowrisk.plans import training
    rows = flows(spark, FOLDER).filter("flow_id < 2000").drop("host_id", "ts", "k")
    few = ForestParams(trees=2, depth=3, max_bins=16)
    fit, meet = FlowModel.fit, threading.Barrier(2)

    def fit_together(*args, **options):
        meet.wait(60)  # breaks if the other fold's fit only starts after this one
        return fit(*args, **options)

    monkeypatch.setattr(FlowModel, "fit", fit_together)
    together = cross_validate(rows, "label", "flow_id", 2, few)
    monkeypatch.setattr(FlowModel, "fit", fit)
    monkeypatch.setattr(training, "CACHED_IDS", 0)
    in_turn = cross_validate(rows, "label", "flow_id", 2, few)
    assert together.count() == in_turn.count() == rows.count()
    assert together.groupBy("fold").count().exceptAll(in_turn.groupBy("fold").count()).isEmpty()
