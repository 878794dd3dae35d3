"""Every registered query: the SQL check where there is one, else rows and a stable schema."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, difference

FOREST = {"rf_train_score", "rf_batch_scores", "rf_detections", "rf_importances", "model_info", "model_roundtrip",
          "cross_validation", "cross_validation_report", "training_run", "score_file", "baseline_forest", "encoded_forest"}
LARGER = "/root/testdata/sf0.01"  # where forests have enough flows to reach their bar
ADDED = {k for k in queries() if k.startswith("op") or k == "pipeline"}  # see their own tests


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(FOREST))
def test_forest_query_equals_sql(spark, name):
    assert difference(queries()[name](spark, LARGER), connect(LARGER), oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - FOREST - ADDED))
def test_query_equals_sql(spark, folder, con, name):
    assert difference(queries()[name](spark, folder), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - ADDED))
def test_query_gives_rows(spark, folder, name):
    assert queries()[name](spark, folder).count() > 0


def test_checks_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "host_id"
