"""Row-order computations that stay balanced when one key holds most of the rows.

A window partitioned by key puts each key in one task. `KeyOrder` keeps that plan
for ordinary keys and cuts each hot key into slices of its sequence: a range
shuffle on (key, order) written once to the shared folder. A frame of the last w
rows then needs only the w-1 rows before the slice (its halo), and a running total
only the sums of the slices before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from flowrisk.session import written

# A key with more rows than this is hot, and a slice holds about as many, or `SLICE_ROWS`.
HOT_ROWS = 2_000_000
# At most this many keys can be hot: the bound also rises with total rows / MAX_HOT.
MAX_HOT = 50_000
# Beyond a slice per shuffle partition, slices hold at least this many rows: each costs a task and a file.
SLICE_ROWS = 50_000

AddColumns = Callable[[DataFrame, WindowSpec], DataFrame]


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


@dataclass(frozen=True)
class KeyOrder:
    """Rows in (keys, order) sequence; ``order`` must end in a unique column."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    plain: DataFrame | None   # rows of ordinary keys
    sliced: DataFrame | None  # rows of hot keys, with _hot (key number) and _slice

    @staticmethod
    def of(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           hot_rows: int = HOT_ROWS) -> KeyOrder:
        """No keys means one sequence over the whole table, always cut into slices."""
        keys, order = tuple(keys), tuple(order)
        spark = df.sparkSession
        if not keys:
            return KeyOrder(keys, order, None, _cut(df.withColumn("_hot", F.lit(0)), order, df.count(), hot_rows))
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        total = counts.agg(F.sum("_n")).scalar()
        hot = counts.filter(F.col("_n") > F.greatest(F.lit(hot_rows), total / MAX_HOT)).collect()
        if not hot:
            return KeyOrder(keys, order, df, None)
        listed = spark.createDataFrame(
            [(*[r[k] for k in keys], i) for i, r in enumerate(hot)],
            counts.select(*keys, F.lit(0).alias("_hot")).schema,
        )
        listed = F.broadcast(listed)  # at most MAX_HOT rows
        same = _same(df, listed, keys)
        rows = df.join(listed, same).select(df["*"], listed["_hot"])
        return KeyOrder(keys, order, df.join(listed, same, "left_anti"),
                        _cut(rows, order, sum(r["_n"] for r in hot), hot_rows))

    def frames(self, width: int, add: AddColumns) -> KeyOrder:
        """Columns that depend on a row and the ``width - 1`` rows before it.

        ``add(df, window)`` appends columns computed over ``window`` and neither
        drops nor multiplies rows.
        """
        plain, sliced = self.plain, self.sliced
        if plain is not None:
            plain = add(plain, Window.partitionBy(*self.keys).orderBy(*self.order))
        if sliced is not None:
            rows = sliced.withColumn("_halo", F.lit(False))
            if width > 1:
                rows = rows.unionByName(self._halo(width - 1).withColumn("_halo", F.lit(True)))
            window = Window.partitionBy("_hot", "_slice").orderBy(*self.order)
            sliced = add(rows, window).filter(~F.col("_halo")).drop("_halo")
        return replace(self, plain=plain, sliced=sliced)

    def running_sum(self, value: str, name: str) -> KeyOrder:
        """Sum of ``value`` from the first row of the key to the current one."""
        plain, sliced = self.plain, self.sliced
        if plain is not None:
            window = Window.partitionBy(*self.keys).orderBy(*self.order)
            plain = plain.withColumn(name, F.sum(value).over(_so_far(window)))
        if sliced is not None:
            slices = Window.partitionBy("_hot").orderBy("_slice")
            before = (
                sliced.groupBy("_hot", "_slice").agg(F.sum(value).alias("_sum"))
                .withColumn("_before", F.coalesce(
                    F.sum("_sum").over(slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .drop("_sum")
            )
            within = Window.partitionBy("_hot", "_slice").orderBy(*self.order)
            sliced = (
                sliced.withColumn("_within", F.sum(value).over(_so_far(within)))
                .join(F.broadcast(before), ["_hot", "_slice"])  # one row per slice
                .withColumn(name, F.col("_before") + F.col("_within"))
                .drop("_before", "_within")
            )
        return replace(self, plain=plain, sliced=sliced)

    def rows(self) -> DataFrame:
        """All rows with the columns added so far."""
        if self.sliced is None:
            return self.plain
        sliced = self.sliced.drop("_hot", "_slice")
        return sliced if self.plain is None else self.plain.unionByName(sliced)

    def _halo(self, depth: int) -> DataFrame:
        """Copies of the last ``depth`` rows before each slice, labelled with that slice."""
        columns = self.sliced.columns
        by_slice = Window.partitionBy("_hot").orderBy("_slice")
        # One row per slice: position among the slices of its key, rows up to its end.
        slices = (
            self.sliced.groupBy("_hot", "_slice").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_at", F.row_number().over(by_slice))
            .withColumn("_end", F.sum("_n").over(_so_far(by_slice)))
        )
        last = Window.partitionBy("_hot", "_slice").orderBy(*[F.desc(c) for c in self.order])
        tails = (
            self.sliced.withColumn("_back", F.row_number().over(last))
            .filter(F.col("_back") <= depth)
            .join(F.broadcast(slices.drop("_n")), ["_hot", "_slice"])
            .withColumn("_into", F.explode(F.sequence(F.col("_at") + 1, F.col("_at") + depth)))
        )
        into = slices.select(
            "_hot", F.col("_at").alias("_into"), F.col("_slice").alias("_to"),
            (F.col("_end") - F.col("_n")).alias("_start"),
        )
        # A short slice lets rows of the one before reach into the next as well.
        return (
            tails.join(F.broadcast(into), ["_hot", "_into"])
            .filter(F.col("_start") - F.col("_end") + F.col("_back") <= depth)
            .withColumn("_slice", F.col("_to"))
            .select(*columns)
        )


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _cut(rows: DataFrame, order: Sequence[str], n_rows: int, hot_rows: int) -> DataFrame:
    default = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Slices are listed in small tables that are sent along, so their number has a bound:
    # like that of a hot key, their size rises with the table. Where keys are hot from a few rows
    # on, slices of as few would make more tasks than work.
    n = max(default, min(-(-n_rows // max(hot_rows, SLICE_ROWS)), MAX_HOT))
    cut = rows.repartitionByRange(n, "_hot", *order).withColumn("_slice", F.spark_partition_id())
    # Range bounds come from a sample, so the slices must not be computed twice.
    return written(cut, "slices")
