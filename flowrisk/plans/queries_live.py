"""Queries that run the events as a stream to its end; most give what the batch gives."""

from pyspark.sql import functions as F

from flowrisk.operators.report import sliding_risk
from flowrisk.plans.queries_trend import (
    _OBSERVED, _REASON_SQL, _RESULT, _RESULT_SQL, _SENTENCE_SQL, BUCKET_FORECAST_SQL, GAP, QUIET_SQL, SLIDING_SQL, _reason,
)
from flowrisk.plans.registry import HOST, ORDER, query, r6, sql6
from flowrisk.plans.scoring import RESULT_COLUMNS
from flowrisk.session import shared_path
from flowrisk.sources.event_flows import detections, flows_of, read_events
from flowrisk.streaming import live
from flowrisk.streaming.source import dataset_stream, drain, each_batch, file_stream, replayed, rocksdb_state
from flowrisk.streaming.trend import TrendBatches, bucket_forecast_stream, forecast_stream


BATCHES = 5
HOT_FLOWS = 500  # rows of a batch from which its key is sliced
_replays: dict[tuple, tuple] = {}


DELAY = 12  # hours that events are late at most where they come out of order


def _replay(spark, folder, closing, shuffled=False):
    """The events in order, in five micro-batches; with ``closing`` a sixth whose only event,
    without a user, comes a month later and so closes all windows before it.

    With ``shuffled`` each event arrives up to ``DELAY`` hours late, so batches overlap in time."""
    key = (spark.sparkContext.applicationId, folder, closing, shuffled)
    if key not in _replays:
        events = read_events(spark, folder)
        if shuffled:
            late = F.make_dt_interval(secs=F.pmod(F.xxhash64("event_id"), F.lit(DELAY * 3600)).cast("decimal(18,6)"))
            path, _ = replayed(events.withColumn("arrival", F.col("ts") + late), "arrival", BATCHES)
        else:
            path, _ = replayed(events, "ts", BATCHES)
        if closing:
            late = events.agg(F.max("ts").alias("ts")).select(*[
                (F.col("ts") + F.expr("INTERVAL 30 DAYS") if c == "ts" else F.lit(None)).cast(events.schema[c].dataType).alias(c)
                for c in events.columns])
            late.coalesce(1).write.mode("append").parquet(path)
        _replays[key] = path, events.schema
    return _replays[key]


def _stream(spark, folder, closing=False, shuffled=False):
    path, schema = _replay(spark, folder, closing, shuffled)
    return detections(flows_of(file_stream(spark, path, schema, files_per_batch=1)))


@query("""SELECT flow_id, predicted_label, is_attack, confidence, attack_probability, risk_score, risk_level
          FROM scored""", "scored")
def stream_scores(spark, folder):
    return drain(_stream(spark, folder).select("flow_id", *RESULT_COLUMNS[:6]))


@query("SELECT flow_id, predicted_label, risk_score, risk_level FROM scored WHERE is_attack", "scored")
def stream_alerts(spark, folder):
    return drain(live.alerts(_stream(spark, folder)).select("flow_id", "predicted_label", "risk_score", "risk_level"))


@query(f"""SELECT coalesce(predicted_label, 'all') AS predicted_label, count(*) AS flows,
            count(*) FILTER (NOT is_attack) AS safe, count(*) FILTER (is_attack) AS threats,
            {sql6("100e0 * count(*) FILTER (NOT is_attack) / count(*)")} AS safe_percent
          FROM scored GROUP BY ROLLUP (predicted_label)""", "scored")
def stream_kpis(spark, folder):
    made = live.running_kpis(_stream(spark, folder)).select(
        "predicted_label", "flows", "safe", "threats", r6("safe_percent"))
    return drain(made, "complete")


@query("SELECT host_id, count(*) AS flows, count(*) FILTER (is_attack) AS threats FROM scored GROUP BY 1", "scored")
def stream_flow_counts(spark, folder):
    return drain(live.flow_counts(_stream(spark, folder), HOST), "complete")


@query(f"SELECT flow_id, host_id, {_RESULT_SQL}, {_REASON_SQL}, {_SENTENCE_SQL} FROM forecasts", "forecasts")
def stream_forecast(spark, folder):
    observed = _stream(spark, folder).select(*_OBSERVED)
    return drain(forecast_stream(observed, HOST, ORDER).select("flow_id", "host_id", *_RESULT, *_reason(), "forecast_reason"))


@query(f"SELECT flow_id, host_id, {_RESULT_SQL} FROM forecasts", "forecasts")
def stream_forecast_batches(spark, folder):
    observed = _stream(spark, folder).select(*_OBSERVED)
    out, state = shared_path(spark, "forecasts"), shared_path(spark, "state")
    each_batch(observed, TrendBatches(out, state, HOST, ORDER), shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(f"{out}/batch=*").select("flow_id", "host_id", *_RESULT)


@query(f"SELECT flow_id, host_id, {_RESULT_SQL}, {_REASON_SQL} FROM forecasts", "forecasts")
def stream_forecast_held(spark, folder):
    """Events out of order, held back until the watermark has passed them: the forecasts of the batch."""
    rows = live.event_time(_stream(spark, folder, closing=True, shuffled=True).select(*_OBSERVED), late=f"{DELAY + 1} hours")
    return drain(forecast_stream(rows, HOST, ORDER, ts="ts", hold=True).select("flow_id", "host_id", *_RESULT, *_reason()))


_HOT_SQL = f"""SELECT flow_id, floor(raw * 1e2 + 0.5e0) / 1e2 AS forecast_risk_score, CAST(n AS INTEGER) AS windows_observed
  FROM (SELECT flow_id, n, CASE WHEN n < 2 THEN 0e0 ELSE floor(greatest(0e0, least(100e0,
      0.45e0 * floor(greatest(0e0, least(100e0, slope * 1000e0)) * 1e9 + 0.5e0) / 1e9
      + 0.35e0 * floor(momentum / (n * (n + 1) / 2e0) * 1e9 + 0.5e0) / 1e9
      + 20e0 * suspicious / n)) * 1e9 + 0.5e0) / 1e9 END AS raw
    FROM (SELECT flow_id, count(*) OVER w AS n,
        CASE WHEN count(*) OVER w >= 2 THEN regr_slope(forecast_attack_prob, rn) OVER w ELSE 0e0 END AS slope,
        sum(risk_score * rn) OVER w - (min(rn) OVER w - 1) * sum(risk_score) OVER w AS momentum,
        sum(CAST(is_attack AS INTEGER)) OVER w AS suspicious
      FROM (SELECT *, row_number() OVER (PARTITION BY gateway ORDER BY ts, flow_id) AS rn
            FROM (SELECT *, CASE WHEN flow_id % 10 < 9 THEN -1 ELSE host_id END AS gateway FROM scored))
      WINDOW w AS (PARTITION BY gateway ORDER BY ts, flow_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)))"""


@query(_HOT_SQL, "scored")
def stream_forecast_hot_key(spark, folder):
    """Nine tenths of all flows under one key, which each batch cuts into slices."""
    gateway = F.when(F.col("flow_id") % 10 < 9, -1).otherwise(F.col("host_id"))
    observed = _stream(spark, folder).select(*_OBSERVED).withColumn("gateway", gateway)
    out, state = shared_path(spark, "forecasts"), shared_path(spark, "state")
    writer = TrendBatches(out, state, ["gateway"], ORDER, hot_rows=HOT_FLOWS)
    each_batch(observed, writer, shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(f"{out}/batch=*").select("flow_id", "forecast_risk_score", "windows_observed")


@query(SLIDING_SQL, "scored")
def stream_sliding_risk(spark, folder):
    """Overlapping windows merged from panes, both on the stream."""
    rows = live.event_time(_stream(spark, folder, closing=True).select(*_OBSERVED))
    made = drain(sliding_risk(rows, "3 days", "1 day", keys=HOST))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return made.withColumns(times | {c: r6(c) for c in ("forecast_attack_prob", "mean_risk")})


@query(BUCKET_FORECAST_SQL, "scored")
def stream_bucket_forecast(spark, folder):
    """Buckets filled by the stream, and the forecast over them on the same stream."""
    rows = live.event_time(_stream(spark, folder, closing=True).select(*_OBSERVED))
    with rocksdb_state(spark):
        made = drain(bucket_forecast_stream(rows, "1 day", HOST))
    return made.select("host_id", F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"),
                       "forecast_risk_score", "windows_observed")


@query(f"""SELECT date_trunc('hour', ts) AS bucket_start, count(*) AS flows,
            count(*) FILTER (is_attack) AS threats, {sql6("avg(risk_score)")} AS mean_risk, max(risk_score) AS risk_score
          FROM scored GROUP BY 1""", "scored")
def stream_buckets(spark, folder):
    rows = live.event_time(_stream(spark, folder, closing=True).select(*_OBSERVED))
    made = drain(live.bucket_risk(rows, "1 hour"))
    return made.select(F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"), "flows", "threats",
                       r6("mean_risk"), "risk_score")


@query("""SELECT host_id, min(ts) AS session_start, max(ts) + INTERVAL 8 HOUR AS session_end, count(*) AS flows,
            count(*) FILTER (is_attack) AS threats, max(risk_score) AS risk_score
          FROM (SELECT *, sum(starts) OVER (PARTITION BY host_id ORDER BY ts, flow_id) AS session_id
            FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY host_id ORDER BY ts, flow_id) + INTERVAL 8 HOUR
              THEN 0 ELSE 1 END AS starts FROM scored)) GROUP BY host_id, session_id""", "scored")
def stream_sessions(spark, folder):
    rows = live.event_time(_stream(spark, folder, closing=True).select(*_OBSERVED))
    made = drain(live.session_activity(rows, HOST, "8 hours"))
    return made.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query(QUIET_SQL, "scored")
def stream_quiet_forecast(spark, folder):
    """The trend of a host starts anew after a quiet period, in keyed state over several batches."""
    rows = live.event_time(_stream(spark, folder).select(*_OBSERVED))
    made = drain(forecast_stream(rows, HOST, ORDER, ts="ts", quiet=GAP))
    return made.select("flow_id", "forecast_risk_score", "windows_observed")


@query("SELECT flow_id, host_id, label FROM flows")
def stream_dataset(spark, folder):
    """The table as it lies, one file or a folder of part files, read as a stream."""
    path = f"{folder}/events.parquet"
    return drain(flows_of(dataset_stream(spark, path, read_events(spark, folder).schema)).select("flow_id", "host_id", "label"))


@query(f"SELECT CAST({BATCHES} AS BIGINT) AS batches, count(*) AS flows FROM flows")
def stream_batches(spark, folder):
    """Micro-batches that the replayed events take, and the flows in them."""
    out = shared_path(spark, "batches")

    def keep(batch, number):
        batch.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    each_batch(_stream(spark, folder).select("flow_id"), keep, shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(f"{out}/batch=*").filter("n > 0").agg(F.count(F.lit(1)).alias("batches"), F.sum("n").alias("flows"))
