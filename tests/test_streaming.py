from pathlib import Path

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from flowrisk.operators.forecast import FORECAST_COLUMNS, forecast
from flowrisk.operators.rolling import sessions
from flowrisk.plans.queries_trend import _OBSERVED
from flowrisk.plans.registry import scored
from flowrisk.streaming import live
from flowrisk.streaming.source import append_to, dataset_stream, drain, each_batch, file_stream, replayed, rocksdb_state
from flowrisk.streaming.trend import TrendBatches, _in_order, bucket_forecast_stream, forecast_stream

HOST, ORDER = ["host_id"], ["ts", "flow_id"]
RESULT = ["flow_id", "forecast_risk_score", "forecast_risk_level", "windows_observed", "reason_codes"]


@pytest.fixture(scope="module")
def observed(spark, folder):
    return scored(spark, folder).select(*_OBSERVED).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture(scope="module")
def files(observed, tmp_path_factory):
    """Five files in time order, so that each micro-batch follows the one before."""
    path = str(tmp_path_factory.mktemp("stream"))
    n = observed.count()
    ordered = observed.withColumn("part", F.floor(F.col("flow_id") * 5 / n))
    for i in range(5):
        ordered.filter(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, observed, files):
    return file_stream(spark, files, observed.schema, files_per_batch=1)


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_events_come_in_time_order(observed):
    pairs = observed.orderBy("ts").select("flow_id").collect()
    assert [r[0] for r in pairs] == sorted(r[0] for r in pairs)


@pytest.mark.parametrize("keys", [HOST, ["all"]])
def test_keyed_state_equals_batch(spark, observed, files, keys):
    rows = observed.withColumn("all", F.lit(1))
    made = drain(forecast_stream(stream(spark, observed, files).withColumn("all", F.lit(1)), keys, ORDER))
    same(made.select(RESULT), forecast(rows, keys, ORDER).select(RESULT))


@pytest.mark.parametrize("hot_rows", [20, 1_000_000])
def test_batches_equal_batch(spark, observed, files, tmp_path, hot_rows):
    writer = TrendBatches(str(tmp_path / "out"), str(tmp_path / "state"), HOST, ORDER, hot_rows=hot_rows)
    each_batch(stream(spark, observed, files), writer, str(tmp_path / "check")).awaitTermination()
    expected = forecast(observed, HOST, ORDER).select(RESULT)
    same(spark.read.parquet(str(tmp_path / "out" / "batch=*")).select(RESULT), expected)
    # A repeated batch overwrites itself; its files are new, so they are listed again.
    again = observed.filter(F.col("flow_id") >= observed.count() * 4 / 5)
    writer(again, 4)
    same(spark.read.parquet(str(tmp_path / "out" / "batch=*")).select(RESULT), expected)


QUIET = "90 minutes"


def quiet_batch(observed):
    rows = sessions(observed, HOST, "ts", ORDER, QUIET, "_session")
    return forecast(rows, [*HOST, "_session"], ORDER).select(RESULT)


def test_quiet_period_restarts_keyed_state(spark, observed, files):
    rows = live.event_time(stream(spark, observed, files))
    made = drain(forecast_stream(rows, HOST, ORDER, ts="ts", quiet=QUIET))
    same(made.select(RESULT), quiet_batch(observed))
    assert made.filter("windows_observed = 1").count() > 150


def test_quiet_period_restarts_batches(spark, observed, files, tmp_path):
    writer = TrendBatches(str(tmp_path / "out"), str(tmp_path / "state"), HOST, ORDER, quiet=QUIET)
    each_batch(stream(spark, observed, files), writer, str(tmp_path / "check")).awaitTermination()
    same(spark.read.parquet(str(tmp_path / "out" / "batch=*")).select(RESULT), quiet_batch(observed))


def test_micro_batches_hold_one_file(spark, observed, files, tmp_path):
    seen = []
    each_batch(stream(spark, observed, files), lambda batch, i: seen.append(batch.count()),
               str(tmp_path / "check")).awaitTermination()
    assert len(seen) == 5 and sum(seen) == observed.count()


@pytest.mark.parametrize("parts", [1, 4])
def test_dataset_as_a_stream(spark, observed, tmp_path, parts):
    path = str(tmp_path / "events.parquet")
    observed.repartition(parts).write.parquet(path)
    whole = drain(dataset_stream(spark, path, observed.schema))
    same(whole, observed)
    lone = next(p for p in (tmp_path / "events.parquet").iterdir() if p.name.startswith("part-"))
    assert drain(dataset_stream(spark, str(lone), observed.schema)).count() == spark.read.parquet(str(lone)).count()
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        dataset_stream(spark, str(tmp_path / "empty"), observed.schema)


def test_buckets_close_behind_the_watermark(spark, observed, files):
    rows = live.event_time(stream(spark, observed, files), late="0 seconds")
    made = drain(live.bucket_risk(rows, "1 hour"))
    batch = live.bucket_risk(observed, "1 hour")
    columns = ["bucket_start", "flows", "threats", "risk_score"]
    closed = made.select(columns)
    assert closed.exceptAll(batch.select(columns)).count() == 0
    assert 0 < closed.count() <= batch.count()


def test_running_counts(spark, observed, files):
    made = drain(live.flow_counts(stream(spark, observed, files), HOST), "complete")
    same(made, live.flow_counts(observed, HOST))


def test_forecast_columns_of_the_stream(spark, observed, files):
    made = forecast_stream(stream(spark, observed, files), HOST, ORDER)
    assert made.columns == [*observed.columns, *FORECAST_COLUMNS]
    assert made.isStreaming


def shuffled(spark, observed, tmp_path):
    """Each file has rows of the whole time; a last row, much later, lets the watermark pass all others."""
    path = str(tmp_path / "shuffled")
    for i in range(5):
        observed.filter(F.pmod(F.xxhash64("flow_id"), F.lit(5)) == i).coalesce(1).write.mode("append").parquet(path)
    late = observed.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("flow_id"), F.lit(None).cast("long").alias("host_id"),
        (F.col("ts") + F.expr("INTERVAL 900 DAYS")).alias("ts"), F.lit("Normal").alias("predicted_label"),
        F.lit(0.0).alias("forecast_attack_prob"), F.lit(0.0).alias("risk_score"))
    late.coalesce(1).write.mode("append").parquet(path)
    return live.event_time(stream(spark, observed, path), late="400 days")


@pytest.mark.parametrize("quiet", [None, QUIET])
def test_rows_out_of_order_are_held_back(spark, observed, tmp_path, quiet):
    made = forecast_stream(shuffled(spark, observed, tmp_path), HOST, ORDER, ts="ts", hold=True, quiet=quiet)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    append_to(made, out, checkpoint).awaitTermination()
    same(spark.read.parquet(out).select(RESULT), quiet_batch(observed) if quiet else forecast(observed, HOST, ORDER).select(RESULT))
    # Only the last row still waits; with quiet periods the others' trends have gone as well.
    left = spark.read.format("statestore").load(checkpoint).select("key", "value.groupState.*")
    assert left.filter("waiting is not null").count() == 1
    assert left.count() == (1 if quiet else 1 + observed.select("host_id").distinct().count())


def test_many_keys_share_a_state(spark, observed, tmp_path):
    big = F.when(F.col("flow_id") % 3 > 0, F.lit(2**60) + F.col("flow_id"))
    rows = observed.withColumn("host_id", F.when(F.col("host_id") % 5 > 0, F.col("host_id"))).withColumn("big", big)
    path, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "check"))
    for i in range(2):
        rows.filter(F.pmod(F.xxhash64("flow_id"), F.lit(2)) == i).coalesce(1).write.mode("append").parquet(path)
    append_to(forecast_stream(stream(spark, rows, path), HOST, ["flow_id"], parts=2), out, checkpoint).awaitTermination()
    made = spark.read.parquet(out)
    same(made.select("flow_id", "host_id", "big"), rows.select("flow_id", "host_id", "big"))
    arrival = rows.withColumn("batch", F.pmod(F.xxhash64("flow_id"), F.lit(2)))
    want = [forecast(arrival, HOST, ["batch", "flow_id"]), forecast(arrival.withColumn("batch", -F.col("batch")), HOST, ["batch", "flow_id"])]
    found = [made.select(RESULT).exceptAll(w.select(RESULT)).isEmpty() for w in want]
    assert any(found)  # the files come in either order
    assert spark.read.format("statestore").load(checkpoint).count() <= 2


def test_rows_held_back_need_a_time(observed):
    with pytest.raises(ValueError):
        forecast_stream(observed, HOST, ["flow_id"], ts="ts", hold=True)
    with pytest.raises(ValueError):
        forecast_stream(observed, HOST, ORDER, hold=True)


def written_buckets(tmp_path, batch):
    return {int(p.name.split("=")[1]) for p in (tmp_path / "state" / "rows" / f"batch={batch}").glob("state_bucket=*")}


def test_a_batch_rewrites_the_buckets_of_its_keys(spark, observed, tmp_path):
    writer = TrendBatches(str(tmp_path / "out"), str(tmp_path / "state"), HOST, ORDER, buckets=64)
    bucket = F.pmod(F.xxhash64("host_id"), F.lit(64))
    half, few = observed.filter("flow_id < 500"), observed.filter("flow_id >= 500 and host_id in (1, 2, 3)")
    writer(half, 0)
    writer(few, 1)
    touched = {r[0] for r in few.select(bucket).distinct().collect()}
    assert written_buckets(tmp_path, 1) == touched < written_buckets(tmp_path, 0)
    assert writer.newest(spark, 1) == {b: 1 if b in touched else 0 for b in written_buckets(tmp_path, 0) | touched}
    rest = observed.filter("flow_id >= 500 and host_id not in (1, 2, 3)")
    writer(rest, 2)
    same(spark.read.parquet(str(tmp_path / "out" / "batch=*")).select(RESULT), forecast(observed, HOST, ORDER).select(RESULT))


def test_a_repeated_batch_changes_nothing(spark, observed, tmp_path):
    writer = TrendBatches(str(tmp_path / "out"), str(tmp_path / "state"), HOST, ORDER)
    writer(observed.filter("flow_id < 500"), 0)
    writer(observed.filter("flow_id >= 500"), 1)
    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    before = files()
    writer(observed.filter("flow_id >= 500"), 1)
    assert files() == before
    # Without its commit the batch is made anew, from the state before it.
    for p in (tmp_path / "state" / "commits" / "batch=1").iterdir():
        p.unlink()
    writer(observed.filter("flow_id >= 500"), 1)
    same(spark.read.parquet(str(tmp_path / "out" / "batch=*")).select(RESULT), forecast(observed, HOST, ORDER).select(RESULT))
    with pytest.raises(RuntimeError):
        writer(observed, 7)


def test_a_key_of_most_rows_is_no_single_task(spark, observed, tmp_path):
    rows = observed.withColumn("host_id", F.when(F.col("flow_id") % 10 < 9, -1).otherwise(F.col("host_id")))
    writer = TrendBatches(str(tmp_path / "out"), str(tmp_path / "state"), HOST, ORDER, hot_rows=60)
    for i in range(4):
        writer(rows.filter((F.col("flow_id") >= 250 * i) & (F.col("flow_id") < 250 * i + 250)), i)
    same(spark.read.parquet(str(tmp_path / "out" / "batch=*")).select(RESULT), forecast(rows, HOST, ORDER).select(RESULT))
    # The state of the hot key is cut to its last rows before rows are shuffled.
    from flowrisk.operators.rolling import latest_rows
    plan = latest_rows(rows, HOST, ORDER, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    cut = forecast(rows, HOST, ORDER, hot_rows=60)._jdf.queryExecution().executedPlan().toString()
    assert "_hot" in cut and "_slice" in cut


def test_sliding_windows_count_each_row_once_per_pane(spark, observed):
    from flowrisk.operators.report import sliding_risk
    made = sliding_risk(observed, "3 hours", "1 hour", keys=HOST)
    plain = observed.groupBy("host_id", F.window("ts", "3 hours", "1 hour")).agg(F.count(F.lit(1)).alias("flows"), F.max("risk_score").alias("risk_score"))
    same(made.select("host_id", "window_start", "flows", "risk_score"), plain.select("host_id", "window.start", "flows", "risk_score"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.index("Aggregate") < plan.index("Expand")  # windows multiply panes, not rows


def test_bucket_forecast_runs_two_stateful_operators(spark, observed, files):
    rows = live.event_time(stream(spark, observed, files), late="0 seconds")
    with rocksdb_state(spark):
        made = drain(bucket_forecast_stream(rows, "1 day", HOST))
    batch = forecast(live.bucket_risk(observed, "1 day", keys=HOST).withColumn(
        "forecast_attack_prob", F.round("forecast_attack_prob", 6)), HOST, ["bucket_start"])
    columns = ["host_id", "bucket_start", "windows_observed", "trend_flagged"]
    assert 0 < made.count() <= batch.count()
    assert made.select(columns).exceptAll(batch.select(columns)).count() == 0


def test_keys_share_the_states_of_their_buckets(spark, observed, files):
    host = F.when(F.col("host_id") % 5 > 0, F.col("host_id") + F.lit(2**53 + 1))  # beyond what a float can tell apart, and NULL
    rows = live.event_time(stream(spark, observed, files).withColumn("host_id", host), late="0 seconds")
    with rocksdb_state(spark):
        made = drain(bucket_forecast_stream(rows, "1 day", HOST, parts=2))
    batch = forecast(live.bucket_risk(observed.withColumn("host_id", host), "1 day", keys=HOST).withColumn(
        "forecast_attack_prob", F.round("forecast_attack_prob", 6)), HOST, ["bucket_start"])
    columns = ["host_id", "bucket_start", "windows_observed", "trend_flagged"]
    assert made.count() > made.select("host_id").distinct().count() > 8
    assert made.select(columns).exceptAll(batch.select(columns)).count() == 0


def test_a_replayed_batch_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(600_000).select(F.xxhash64("id").alias("id"), F.timestamp_seconds("id").alias("ts"))
    path, _ = replayed(rows, "ts", parts=1)
    lone, = Path(path.removeprefix("file:")).glob("part-*")
    assert pq.ParquetFile(str(lone)).num_row_groups > 1


@pytest.mark.parametrize("missing", [False, True])
def test_rows_of_a_key_in_order(missing):
    rows = pd.DataFrame({"ts": pd.to_datetime([5, 3, 3, 9, 1]), "id": [1, 9, 2, 0, 4], "text": list("edcba")})
    if missing:
        rows.loc[3, "ts"] = pd.NaT
    for order in (["ts", "id"], ["text"], ["id"]):
        made, plain = _in_order(rows, order), rows.sort_values(order, na_position="first")
        assert made["id"].tolist() == plain["id"].tolist()


def test_buckets_of_the_state_are_written_by_many_tasks(spark, observed, tmp_path):
    TrendBatches(str(tmp_path / "out"), str(tmp_path / "state"), HOST, ORDER)(observed, 0)
    # A file's name begins with the number of its task.
    tasks = {p.name.split("-")[1] for p in (tmp_path / "state" / "rows").rglob("part-*.parquet")}
    assert len(tasks) > 1
