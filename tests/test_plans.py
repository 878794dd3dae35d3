"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from flowrisk.plans.catalog import QUERIES


def plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", [
    "flow_features", "batch_scores", "risk_scores", "probability_maps", "clean_flows", "coerce_fill", "flow_search"])
def test_row_level_queries_do_not_shuffle(spark, folder, capsys, name):
    assert "Exchange" not in plan(QUERIES[name](spark, folder), capsys)


@pytest.mark.parametrize("name", ["split_80_20", "split_stratified", "kfold_assign", "sample_n", "median_impute"])
def test_fitted_projections_do_not_shuffle_rows(spark, folder, capsys, name):
    text = plan(QUERIES[name](spark, folder), capsys)
    assert not re.search(r"Exchange hashpartitioning|SinglePartition|Sort\b|Window\b", text)


@pytest.mark.parametrize("name", ["forecast_all", "rolling_stats", "early_warnings", "flow_counter"])
def test_one_shuffle_and_one_sort_per_trend(spark, folder, capsys, name):
    text = plan(QUERIES[name](spark, folder), capsys)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Sort", text, re.M)) == 1


@pytest.mark.parametrize("name", ["forecast_current", "latest_20_per_host"])
def test_rows_per_key_are_limited_before_the_shuffle(spark, folder, capsys, name):
    text = plan(QUERIES[name](spark, folder), capsys)
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


@pytest.mark.parametrize("name", sorted(set(QUERIES) & {
    "rolling_global", "forecast_global", "forecast_sessions", "session_windows", "time_bucket_forecast", "fold_f1"}))
def test_no_query_gathers_rows_in_one_partition(spark, folder, capsys, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, folder), capsys)


def test_scans_read_only_what_is_used(spark, folder, capsys):
    text = plan(QUERIES["flow_counter"](spark, folder), capsys)
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, folder, capsys, name):
    if name.startswith(("rf_", "stream_", "cross_", "baseline_forest", "encoded_forest", "model_", "training_", "score_file")):
        pytest.skip("runs jobs of its own; its parts are covered by the others")
    text = plan(QUERIES[name](spark, folder), capsys)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
