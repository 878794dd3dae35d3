"""A hot key cut into slices gives what one window over the key gives."""

import pytest
from pyspark.sql import functions as F

from flowrisk.operators.forecast import forecast, trajectory
from flowrisk.operators.ordered import KeyOrder
from flowrisk.operators.rolling import flow_counter, rolling_stats, sessions
from flowrisk.plans.registry import scored


@pytest.fixture(scope="module")
def skewed(spark, folder):
    """Half of the flows of host 0, some hosts with one flow, one without a name."""
    df = scored(spark, folder).withColumn(
        "host_id", F.when(F.col("flow_id") % 2 == 0, 0).when(F.col("flow_id") % 7 == 0, None)
        .when(F.col("flow_id") % 9 == 0, F.col("flow_id") + 1000).otherwise(F.col("host_id")))
    return df.withColumns({"total_bytes": F.col("src_bytes") + F.col("dst_bytes"),
                           "bytes_per_sec": F.col("src_bytes") / (F.col("duration") + 0.001)}).persist()


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# Ten rows per slice: slices shorter than the frame, and frames that span several.
@pytest.mark.parametrize("hot_rows", [2, 10, 60])
def test_forecast(skewed, hot_rows):
    plain = forecast(skewed, ["host_id"], ["ts", "flow_id"])
    same(forecast(skewed, ["host_id"], ["ts", "flow_id"], hot_rows=hot_rows), plain)


@pytest.mark.parametrize("hot_rows", [3, 50])
def test_rolling(skewed, hot_rows):
    def settle(df):
        return df.select("flow_id", *[F.round(c, 6).alias(c) for c in df.columns if "_rolling_" in c])
    plain = rolling_stats(skewed, ["host_id"], ["ts", "flow_id"])
    same(settle(rolling_stats(skewed, ["host_id"], ["ts", "flow_id"], hot_rows=hot_rows)), settle(plain))


def test_trajectory(skewed):
    columns = ["flow_id", "previous_forecast", "threat_acceleration"]
    plain = trajectory(skewed, ["host_id"], ["ts", "flow_id"]).select(columns)
    same(trajectory(skewed, ["host_id"], ["ts", "flow_id"], hot_rows=5).select(columns), plain)


def test_counter_and_sessions(skewed):
    order = ["ts", "flow_id"]
    same(flow_counter(skewed, ["host_id"], order, hot_rows=7).select("flow_id", "flow_number"),
         flow_counter(skewed, ["host_id"], order).select("flow_id", "flow_number"))
    columns = ["flow_id", "session_id"]
    same(sessions(skewed, ["host_id"], "ts", order, "2 hours", hot_rows=7).select(columns),
         sessions(skewed, ["host_id"], "ts", order, "2 hours").select(columns))


def test_whole_table_as_one_sequence(spark, skewed):
    numbered = flow_counter(skewed, [], ["ts", "flow_id"], hot_rows=20).select("flow_number", "ts", "flow_id")
    rows = sorted(numbered.collect(), key=lambda r: r["flow_number"])
    assert [r["flow_number"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows == sorted(rows, key=lambda r: (r["ts"], r["flow_id"]))


def test_only_the_hot_key_is_cut(skewed):
    order = KeyOrder.of(skewed.select("host_id", "ts", "flow_id"), ["host_id"], ["ts", "flow_id"], hot_rows=400)
    assert order.sliced.select("host_id").distinct().collect() == [(0,)]
    assert order.plain.filter("host_id = 0").count() == 0
    largest = order.sliced.groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert largest < order.sliced.count() / 2


def test_slices_do_not_grow_with_rows_over_a_small_bound(spark, skewed, monkeypatch):
    order = KeyOrder.of(skewed.select("host_id", "ts", "flow_id"), ["host_id"], ["ts", "flow_id"], hot_rows=5)
    assert order.sliced.select("_slice").distinct().count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Slices shorter than a frame still give the same rows.
    monkeypatch.setattr("flowrisk.operators.ordered.SLICE_ROWS", 1)
    cut = KeyOrder.of(skewed.select("host_id", "ts", "flow_id"), ["host_id"], ["ts", "flow_id"], hot_rows=5)
    assert cut.sliced.select("_slice").distinct().count() > 50
    same(forecast(skewed, ["host_id"], ["ts", "flow_id"], hot_rows=5), forecast(skewed, ["host_id"], ["ts", "flow_id"]))
