"""The forecast on a stream of detections.

`forecast_stream` keeps each key's last detections in keyed state, many keys in one by their
hash, and computes them together: a call per key would cost more than its arithmetic. It counts them as they arrive or, with ``hold``, keeps rows back
until the watermark has passed them and counts them in event order, whatever order they
arrive in. `TrendBatches` runs the batch forecast on every micro-batch together with
the last rows of its keys: a key that sends most of the rows is cut into slices like in a
batch. `bucket_forecast_stream` forecasts over time buckets that the same stream fills.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowrisk.functions.numeric import half_up
from flowrisk.operators.forecast import (
    ATTACK, FORECAST_COLUMNS, LABEL, RISK, _TREND, _check, _outputs, forecast,
)
from flowrisk.operators.ordered import HOT_ROWS
from flowrisk.operators.report import risk_by_time
from flowrisk.operators.rolling import latest_rows, sessions
from flowrisk.schema import BENIGN, TREND_WINDOW

_STATE = "tails binary, waiting binary"
KEY_PARTS = 1024  # states that the keys of a stream share


def _back(values: np.ndarray, steps: int) -> np.ndarray:
    return np.concatenate([np.zeros(steps), values[:len(values) - steps]]) if steps else values


def _trend_rows(flags, attack, risk, age, window: int) -> dict[str, np.ndarray]:
    """Trend columns per row; ``age`` is the number of earlier rows in the same series."""
    n = np.minimum(age + 1, window).astype("float64")
    suspicious, a, ia, r, ir = (np.zeros(len(flags)) for _ in range(5))
    for i in range(min(window, len(flags))):
        there = age >= i
        suspicious += np.where(there, _back(flags, i), 0.0)
        a_i, r_i = np.where(there, _back(attack, i), 0.0), np.where(there, _back(risk, i), 0.0)
        a += a_i
        ia += i * a_i
        r += r_i
        ir += i * r_i
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = ((n - 1) / 2 * a - ia) * 12 / (n * (n * n - 1))
    return {
        "_n": n.astype("int32"), "_slope": np.where(n >= 2, slope, np.nan),
        "_momentum": (n * r - ir) * 2 / (n * (n + 1)),
        "_suspicious": suspicious.astype("int32"), "_newest": attack,
    }


def _signals(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suspicious flag, attack probability and risk of each row; what is missing is 0."""
    numbers = [rows[c].to_numpy("float64") for c in (ATTACK, RISK)]
    flags = (rows[LABEL].to_numpy("object") != BENIGN).astype("float64")
    return flags, *[np.where(np.isnan(x), 0.0, x) for x in numbers]


def _in_order(rows: pd.DataFrame, order: Sequence[str]) -> pd.DataFrame:
    """Sorted rows, missing values first. A key's rows are few, so plain arrays are sorted if they can be."""
    columns = [rows[c].to_numpy() for c in order]
    if any(c.dtype.kind not in "biuM" or (c.dtype.kind == "M" and np.isnat(c).any()) for c in columns):
        return rows.sort_values(list(order), ignore_index=True, na_position="first")
    at = np.lexsort(columns[::-1])
    return rows if (at[1:] > at[:-1]).all() else rows.take(at)


def _beside(rows: pd.DataFrame, names: Sequence[str], trend: dict[str, np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({c: rows[c].array for c in names} | trend, copy=False)


def _advance(tails: pd.DataFrame | None, rows: pd.DataFrame, window: int,
             pause: int | None = None) -> tuple[pd.DataFrame, dict[str, np.ndarray], pd.DataFrame]:
    """The next rows of many keys, sorted by key, their trend columns, and the last rows after them.

    ``rows`` are in order, their keys in ``_key``. A pause of more than ``pause`` microseconds
    between rows of a key restarts its trend.
    """
    times = rows["_at"].to_numpy("int64") if pause is not None else np.zeros(len(rows), dtype="int64")
    new = pd.DataFrame({"_key": rows["_key"].array, **dict(zip(("_f", "_a", "_r"), _signals(rows))), "_t": times,
                        "_row": np.arange(len(rows))}, copy=False)
    # Earlier rows come first, and the sort by key keeps their order.
    series = new if tails is None else pd.concat([tails, new], ignore_index=True)
    code = pd.factorize(series["_key"])[0]
    at = np.argsort(code, kind="stable")
    code, series = code[at], series.take(at)
    flags, attack, risk, times, row = (series[c].to_numpy() for c in ("_f", "_a", "_r", "_t", "_row"))
    at = np.arange(len(code))
    first = np.ones(len(code), dtype=bool)
    first[1:] = code[1:] != code[:-1]
    starts = first.copy()
    if pause is not None:
        starts[1:] |= (row[1:] >= 0) & (times[1:] - times[:-1] > pause)
    start = np.maximum.accumulate(np.where(starts, at, 0))
    fresh = row >= 0
    trend = {c: v[fresh] for c, v in _trend_rows(flags, attack, risk, at - start, window).items()}
    ends = np.append(np.flatnonzero(first)[1:], len(code))  # of each row's key, and where its last trend starts
    end = np.repeat(ends, np.diff(np.append(np.flatnonzero(first), len(code))))
    last = series[at >= np.maximum(start[end - 1], end - window + 1)].assign(_row=-1)
    return rows.take(row[fresh]), trend, last


_TREND_FIELDS = [
    T.StructField("_n", T.IntegerType()), T.StructField("_slope", T.DoubleType()),
    T.StructField("_momentum", T.DoubleType()), T.StructField("_suspicious", T.IntegerType()),
    T.StructField("_newest", T.DoubleType()),
]


def _with_outputs(trend: DataFrame, window: int) -> DataFrame:
    # NaN from pandas is the missing slope of a first row.
    trend = trend.withColumn("_slope", F.nanvl("_slope", F.lit(None).cast("double")))
    return trend.withColumns(_outputs(window)).drop(*_TREND)


def _stored(rows: pd.DataFrame) -> bytes | None:
    if rows.empty:
        return None
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _waiting(stored: bytes | None) -> list[pd.DataFrame]:
    return [pa.ipc.open_stream(stored).read_all().to_pandas()] if stored else []


def forecast_stream(detections: DataFrame, keys: Sequence[str], order: Sequence[str],
                    window: int = TREND_WINDOW, ts: str | None = None,
                    quiet: str | None = None, hold: bool = False, parts: int = KEY_PARTS) -> DataFrame:
    """Forecast after every detection; append mode. Keys share ``parts`` states by their hash.

    Micro-batches count in arrival order, the rows inside one by ``order``. With ``ts``
    and ``quiet`` (such as ``30 minutes``) a longer pause of a key restarts its trend,
    and a watermark set on ``ts`` frees the state of keys that fell silent.

    With ``hold`` rows wait in their key's state until the watermark on ``ts`` has passed
    them, and count by ``order``, which must begin with ``ts``: the result is that of the
    batch, however rows were shuffled on their way, as long as none is later than the
    watermark allows. Rows without a time don't wait. An event-time timeout releases rows
    of keys that send nothing more.
    """
    _check(window)
    order = list(order)
    if hold and (ts is None or order[0] != ts):
        raise ValueError("rows held back need a time, and an order that begins with it")
    pause = pd.Timedelta(quiet).value // 1000 if quiet else None
    timed = hold or pause is not None
    # A missing whole number would turn those of other keys in the same state into floats.
    whole = [f.name for f in detections.schema.fields if isinstance(f.dataType, T.IntegralType)]
    there = {c: f"_there_{i}" for i, c in enumerate(whole)}
    sorted_by = [x for c in order for x in ([there[c], c] if c in there else [c])]

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get if state.exists else (None, None)
        passed = state.getCurrentWatermarkMs() if timed else 0
        parts = _waiting(old[1]) + ([] if state.hasTimedOut else list(batches))
        rows = (parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)) if parts else None
        later = None
        if hold and rows is not None:
            due = ~(rows["_at"] > passed * 1000)
            rows, later = rows[due], rows[~due]
        tails = next(iter(_waiting(old[0])), None)
        if rows is not None and len(rows):
            rows, trend, tails = _advance(tails, _in_order(rows, sorted_by), window, pause)
            yield _beside(rows, names, trend)
        waits = later is not None and len(later) > 0
        wake = [int(later["_at"].min()) // 1000] if waits else []
        if pause is not None and tails is not None and len(tails):
            # Keys that fell silent start anew with their next row; those that wait are kept.
            until = (tails.groupby("_key", sort=False)["_t"].transform("last") + pause) // 1000
            stays = until >= passed
            if waits:
                stays |= tails["_key"].isin(later["_key"])
            tails = tails[stays]
            wake += [int(until[stays].min())] if len(tails) else []
        if not waits and (tails is None or tails.empty):
            if state.exists:
                state.remove()
            return
        state.update((None if tails is None else _stored(tails), _stored(later) if waits else None))
        if wake:
            state.setTimeoutTimestamp(max(min(wake), passed + 1))

    timeout = GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout
    rows = detections.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp"))) if timed else detections
    rows = rows.withColumn("_key", _key_text(rows, keys))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("_key"), F.lit(parts)))
    rows = rows.withColumns({n: F.col(c).isNotNull() for c, n in there.items()})
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0).cast(detections.schema[c].dataType)) for c in whole})
    fields = detections.schema.fields + [T.StructField(n, T.BooleanType()) for n in there.values()]
    names = [f.name for f in fields]
    trend = rows.groupBy("_part").applyInPandasWithState(
        step, T.StructType(fields + _TREND_FIELDS), _STATE, "append", timeout)
    trend = trend.withColumns({c: F.when(F.col(n), F.col(c)) for c, n in there.items()}).drop(*there.values())
    return _with_outputs(trend, window)


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """The values of the keys as one text, equal for equal keys only; 0.0 and -0.0 are equal."""
    def text(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            return (F.col(c) + F.lit(0.0)).cast("string")
        return F.hex(c) if isinstance(kind, T.BinaryType) else F.col(c).cast("string")

    return F.to_json(F.array(*map(text, keys)))


class _BucketTrend(StatefulProcessor):
    """Trend columns of the closed buckets of many keys; the last ones of each stay as state.

    Keys share a state by their hash: reading and writing a state costs more than the
    arithmetic of a key, and arrays hold the rows of many keys as well as those of one.
    """

    def __init__(self, names: Sequence[str], keys: Sequence[str], bucket: str, window: int):
        self.names, self.keys, self.bucket, self.window = list(names), list(keys), bucket, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tails = handle.getValueState("tails", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True).sort_values(self.bucket, ignore_index=True)
        new = found[self.keys].assign(**dict(zip(("_f", "_a", "_r"), _signals(found))), _at=np.arange(len(found)))
        stored = self.tails.get()
        # Earlier buckets come first, and the sort by key keeps their order.
        series = pd.concat([*_waiting(stored[0] if stored else None), new], ignore_index=True)
        series["_series"] = series.groupby(self.keys, dropna=False, sort=False).ngroup() if self.keys else 0
        series = series.sort_values("_series", kind="stable", ignore_index=True)
        age = series.groupby("_series").cumcount().to_numpy()
        trend = _trend_rows(*[series[c].to_numpy() for c in ("_f", "_a", "_r")], age, self.window)
        last = series.groupby("_series").tail(self.window - 1)
        self.tails.update((_stored(last.drop(columns="_series").assign(_at=-1)),))
        there = series["_at"].to_numpy()
        made = found.iloc[there[there >= 0]]
        yield _beside(made, self.names, {c: v[there >= 0] for c, v in trend.items()})

    def close(self) -> None:
        pass


def bucket_forecast_stream(scored: DataFrame, bucket: str, keys: Sequence[str], ts: str = "ts",
                           window: int = TREND_WINDOW, parts: int = KEY_PARTS) -> DataFrame:
    """Forecast per key after every time bucket, on a stream with a watermark on ``ts``; append mode.

    Two stateful operators in a row: the first closes a bucket when the watermark has passed
    it, the second takes closed buckets, which come in order, and keeps the last of each
    key, in one of ``parts`` states by the key's hash. Needs the RocksDB state store.
    """
    _check(window)
    buckets = risk_by_time(scored, bucket, ts, keys, timed=True)
    buckets = buckets.withColumn(ATTACK, half_up(F.col(ATTACK), 6))
    # A key with a NULL has a state of its own.
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string")
    for c in keys:
        part = F.when(F.col(c).isNull(), F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))).otherwise(part)
    buckets = buckets.withColumn("_part", part)
    # Rows of several states come in one table, where a missing whole number would turn the others into floats.
    whole = {c: buckets.schema[c].dataType for c in keys if isinstance(buckets.schema[c].dataType, T.IntegralType)}
    buckets = buckets.withColumns({c: F.col(c).cast("string") for c in whole})
    names = [c for c in buckets.columns if c not in ("bucket_time", "_part")]
    schema = T.StructType([buckets.schema[c] for c in names] + _TREND_FIELDS)
    trend = buckets.groupBy("_part").transformWithStateInPandas(
        _BucketTrend(names, keys, "bucket_start", window), schema, "append", "None")
    return _with_outputs(trend.withColumns({c: F.col(c).cast(kind) for c, kind in whole.items()}), window)


BUCKETS = 1024  # parts of the state of `TrendBatches`


class TrendBatches:
    """A ``foreachBatch`` writer: forecasts of batch n in ``out/batch=n``.

    The last rows of the keys lie in ``state/rows/batch=n/state_bucket=b``, a bucket by the
    hash of the key. A batch reads and rewrites the buckets of its own keys only. What it
    wrote counts once ``state/commits/batch=n`` is there, a single file that names the
    newest files of every bucket; a batch that has it changes nothing when it is repeated,
    and one that was cut short before it is written anew from the files before. Files of
    older batches stay until the folder's retention takes them.

    Keys of more than ``hot_rows`` rows in a batch are cut into slices, each with the rows
    before it, so one key may send most of a batch; of every task's rows only the last few
    of a key go into the state.
    """

    def __init__(self, out: str, state: str, keys: Sequence[str], order: Sequence[str],
                 window: int = TREND_WINDOW, quiet: str | None = None, hot_rows: int = HOT_ROWS, buckets: int = BUCKETS):
        _check(window)
        self.out, self.state = out.rstrip("/"), state.rstrip("/")
        self.keys, self.order, self.window = list(keys), list(order), window
        self.quiet, self.hot_rows, self.buckets = quiet, hot_rows, buckets

    def newest(self, spark: SparkSession, batch_id: int) -> dict[int, int] | None:
        """The batch that wrote each bucket last, as of a batch; None if that has no commit. At most ``buckets`` rows."""
        try:
            rows = spark.read.schema("bucket int, batch bigint").parquet(f"{self.state}/commits/batch={batch_id}").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        # A marker always has a row, that of bucket -1; a write that was cut short has none.
        return {r["bucket"]: r["batch"] for r in rows if r["bucket"] >= 0} if rows else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.newest(spark, batch_id) is not None:
            return
        before = self.newest(spark, batch_id - 1) if batch_id > 0 else {}
        if before is None:
            raise RuntimeError(f"batch {batch_id - 1} has left no commit in {self.state}")
        batch = batch.persist()  # it is read for its keys, its forecasts and its state
        try:
            bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
            rows = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
            touched = sorted(r["b"] for r in batch.select(bucket.alias("b")).distinct().collect())
            paths = [f"{self.state}/rows/batch={before[b]}/state_bucket={b}" for b in touched if b in before]
            if paths:
                rows = spark.read.schema(rows.schema).parquet(*paths).unionByName(rows)
            order = ["_batch", *self.order]  # arrival first
            keys = self.keys
            series = rows
            if self.quiet:
                series = sessions(rows, keys, self.order[0], order, self.quiet, "_session", self.hot_rows)
                keys = [*keys, "_session"]
            made = forecast(series, keys, order, self.window, self.hot_rows)
            made.filter(F.col("_batch") == batch_id).select(*batch.columns, *FORECAST_COLUMNS).write.mode(
                "overwrite").parquet(f"{self.out}/batch={batch_id}")
            if touched:
                last = latest_rows(rows, self.keys, order, self.window - 1).withColumn("state_bucket", bucket)
                # A file per bucket: with a number given they aren't all left to one task, however small.
                tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
                last.repartition(tasks, "state_bucket").write.partitionBy("state_bucket").mode("overwrite").parquet(
                    f"{self.state}/rows/batch={batch_id}")
        finally:
            batch.unpersist()
        commit = [(-1, batch_id), *sorted((before | dict.fromkeys(touched, batch_id)).items())]
        spark.createDataFrame(commit, "bucket int, batch bigint").coalesce(1).write.mode("overwrite").parquet(
            f"{self.state}/commits/batch={batch_id}")
