import pytest
from pyspark.sql import functions as F

from flowrisk.operators import splits


@pytest.fixture(scope="module")
def rows(spark):
    label = F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 5 == 0, "some").otherwise("most")
    return spark.range(1013).select(F.col("id").alias("flow_id"), label.alias("label"))


@pytest.mark.parametrize("few", [20, 200_000])
@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_random_split_is_exact_and_repeatable(rows, few, method):
    a = splits.random_split(rows, "flow_id", 0.8, 1, method, few)
    assert dict(a.groupBy("split").count().collect()) == {"train": 810, "test": 203}
    again = splits.random_split(rows.repartition(7), "flow_id", 0.8, 1, method, few)
    assert a.exceptAll(again).count() == 0
    other = splits.random_split(rows, "flow_id", 0.8, 2, method, few)
    assert a.exceptAll(other).count() > 0


@pytest.mark.parametrize("few", [20, 200_000])
def test_stratified_split_keeps_shares(rows, few):
    made = splits.stratified_split(rows, "label", "flow_id", 0.75, few=few)
    counts = {(r["label"], r["split"]): r["count"] for r in made.groupBy("label", "split").count().collect()}
    for label, n in rows.groupBy("label").count().collect():
        assert counts[label, "train"] == -(-3 * n // 4)
        assert counts[label, "train"] + counts[label, "test"] == n
    assert made.select("flow_id").distinct().count() == 1013


@pytest.mark.parametrize("k", [2, 5])
def test_folds_are_balanced(rows, k):
    made = splits.stratified_folds(rows, "label", "flow_id", k, few=30)
    assert made.count() == 1013
    for label in ("rare", "some", "most"):
        sizes = [r["count"] for r in made.filter(F.col("label") == label).groupBy("fold").count().collect()]
        assert len(sizes) == k and max(sizes) - min(sizes) <= 1


def test_more_folds_than_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "flow_id bigint, label string")
    made = splits.stratified_folds(df, "label", "flow_id", 5).collect()
    assert len(made) == 3 and all(0 <= r["fold"] < 5 for r in made)


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (100, 100), (5000, 1013)])
def test_sample(rows, n, expected):
    assert splits.sample_rows(rows, "flow_id", n, few=10).count() == expected


def test_empty(spark):
    empty = spark.createDataFrame([], "flow_id bigint, label string")
    assert splits.random_split(empty, "flow_id").count() == 0
    assert splits.stratified_split(empty, "label", "flow_id").count() == 0
    assert splits.stratified_folds(empty, "label", "flow_id").count() == 0


def test_nothing_in_train(spark):
    rows = spark.range(2).withColumnRenamed("id", "i")
    assert splits.random_split(rows, "i", 0.1).filter("split = 'train'").count() == 0


@pytest.mark.parametrize("few", [5, 1000])
def test_many_classes_give_the_same_rows(spark, monkeypatch, few):
    rows = spark.range(900).selectExpr("id AS i", "CASE WHEN id < 300 THEN NULL WHEN id < 600 THEN 'big' ELSE concat('c', id % 60) END AS label")
    split = splits.stratified_split(rows, "label", "i", few=few).select("i", "split").orderBy("i").collect()
    folds = splits.stratified_folds(rows, "label", "i", few=few).select("i", "fold").orderBy("i").collect()
    monkeypatch.setattr("flowrisk.operators.splits.small_rows", lambda df: None)
    assert splits.stratified_split(rows, "label", "i", few=few).select("i", "split").orderBy("i").collect() == split
    assert splits.stratified_folds(rows, "label", "i", few=few).select("i", "fold").orderBy("i").collect() == folds
