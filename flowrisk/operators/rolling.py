"""Rolling statistics, counters, sessions and latest rows over flows in key order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from flowrisk.operators.clean import numeric_columns
from flowrisk.operators.ordered import HOT_ROWS, KeyOrder
from flowrisk.schema import ROLLING_COLUMNS, ROLLING_WINDOW


def rolling_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  window: int = ROLLING_WINDOW, columns: Sequence[str] = ROLLING_COLUMNS,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean and sample deviation of the last ``window`` rows per key; one value deviates by 0.

    Without keys the table is one sequence, computed in slices.
    """
    columns = [c for c in columns if c in numeric_columns(df)]

    def add(rows: DataFrame, spec: WindowSpec) -> DataFrame:
        frame = spec.rowsBetween(1 - window, 0)
        return rows.select("*", *[
            col for c in columns for col in (
                F.avg(c).over(frame).alias(f"{c}_rolling_mean_{window}"),
                F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0))
                .alias(f"{c}_rolling_std_{window}"),
            )
        ])

    return KeyOrder.of(df, keys, order, hot_rows).frames(window, add).rows()


def flow_counter(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 out: str = "flow_number", hot_rows: int = HOT_ROWS) -> DataFrame:
    """1, 2, 3, ... per key in order."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return KeyOrder.of(one, keys, order, hot_rows).running_sum("_one", out).rows().drop("_one")


def sessions(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], gap: str,
             out: str = "session_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number the sessions of each key from 1; a pause longer than ``gap`` starts one.

    ``gap`` is an interval such as ``30 minutes``. ``order`` must start with ``ts``.
    """
    pause = F.expr(f"INTERVAL {gap}")

    def add(rows: DataFrame, spec: WindowSpec) -> DataFrame:
        before = F.lag(ts).over(spec)
        starts = before.isNull() | (F.col(ts) > before + pause)
        return rows.withColumn("_starts", starts.cast("bigint"))

    numbered = KeyOrder.of(df, keys, order, hot_rows).frames(2, add).running_sum("_starts", out)
    return numbered.rows().drop("_starts")


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of each key, or of the table without keys.

    Spark keeps only ``n`` rows per key and map task before the shuffle, so a hot key
    costs no more than ``n`` rows per task.
    """
    newest = [F.desc(c) for c in order]
    if not keys:
        return df.orderBy(*newest).limit(n)
    last = Window.partitionBy(*keys).orderBy(*newest)
    return df.withColumn("_last", F.row_number().over(last)).filter(F.col("_last") <= n).drop("_last")
