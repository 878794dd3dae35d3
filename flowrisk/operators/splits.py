"""Exact seeded splits, folds and samples as filters on a hash key.

Which rows fall on which side is decided by a threshold on the hash, found as an
exact order statistic. The rows themselves are never ranked or shuffled, however
large one class is. Ids must be unique.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowrisk.functions.hashing import seeded_key
from flowrisk.functions.numeric import named
from flowrisk.operators.order_stats import FEW_VALUES, exact_ranks
from flowrisk.operators.small import small_rows

_KEY = "_key"


def _keyed(df: DataFrame, id_col: str, seed: int, method: str) -> DataFrame:
    return df.withColumn(_KEY, seeded_key(named(id_col), seed, method))


def _lowest(df: DataFrame, size: Callable[[int], int], few: int) -> DataFrame:
    """Flag the ``size(rows)`` rows of lowest key as ``_low``."""
    last = exact_ranks(df.select(_KEY), _KEY, None, lambda n: [size(n) - 1] if size(n) > 0 else [], few)
    return df.withColumn("_low", F.col(_KEY) <= F.lit(last[None][0]) if last else F.lit(False))


def _by_label(df: DataFrame, label: str, few: int, listed: Callable[[DataFrame], DataFrame],
              ranked: Callable[[Column, Column], Column], out: str) -> DataFrame:
    """``df`` with ``out``, by ``listed`` or by ``ranked`` (0-based place, rows of the label).

    A few labels, or labels with more than ``few`` rows, are decided by thresholds, so
    that no label is gathered in one task; many small labels are ranked where they are.
    Either way gives the same rows.
    """
    counts = df.groupBy(named(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    if small_rows(counts) is not None:
        return listed(df)
    large = counts.filter(F.col("_n") > few)
    same = named(label).eqNullSafe(F.col("_label"))
    place = F.row_number().over(Window.partitionBy(named(label)).orderBy(_KEY)) - 1
    rows = F.count(F.lit(1)).over(Window.partitionBy(named(label)))
    small = df.join(large, same, "left_anti").withColumn("_place", place).withColumn("_rows", rows)
    small = small.withColumn(out, ranked(F.col("_place"), F.col("_rows"))).drop("_place", "_rows")
    if large.isEmpty():
        return small
    return listed(df.join(large, same, "left_semi")).select(small.columns).unionByName(small)


def random_split(df: DataFrame, id_col: str, fraction: float = 0.8, seed: int = 42,
                 method: str = "xxhash64", few: int = FEW_VALUES) -> DataFrame:
    """Add ``split``: exactly round(fraction * rows) rows ``train``, the others ``test``."""
    low = _lowest(_keyed(df, id_col, seed, method), lambda n: round(fraction * n), few)
    return low.withColumn("split", F.when(F.col("_low"), "train").otherwise("test")).drop(_KEY, "_low")


def stratified_split(df: DataFrame, label: str, id_col: str, fraction: float = 0.75, seed: int = 42,
                     method: str = "xxhash64", few: int = FEW_VALUES) -> DataFrame:
    """Like `random_split` within each class, rounding its training rows up."""
    if fraction <= 0:
        return df.withColumn("split", F.lit("test"))

    def listed(rows: DataFrame) -> DataFrame:
        last = exact_ranks(rows.select(named(label).alias("_of"), _KEY), _KEY, "_of", lambda n: [_ceil(fraction, n) - 1], few)
        kind = rows.schema[label].dataType.simpleString()
        table = rows.sparkSession.createDataFrame(
            [(g, ranks[0]) for g, ranks in last.items()], f"_label {kind}, _last bigint")
        # One row per label.
        return (
            rows.join(F.broadcast(table), named(label).eqNullSafe(F.col("_label")))
            .withColumn("_low", F.col(_KEY) <= F.col("_last")).drop("_label", "_last")
        )

    low = _by_label(_keyed(df, id_col, seed, method), label, few, listed,
                    lambda place, n: place < F.ceil(F.lit(fraction) * n - 1e-9), "_low")
    return low.withColumn("split", F.when(F.col("_low"), "train").otherwise("test")).drop(_KEY, "_low")


def _ceil(fraction: float, n: int) -> int:
    # Guard against products such as 0.1 * 30 = 3.0000000000000004.
    return -int(-(fraction * n - 1e-9) // 1)


def stratified_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42,
                     method: str = "xxhash64", few: int = FEW_VALUES) -> DataFrame:
    """Add ``fold`` 0..k-1; each class is spread over the folds evenly within one row."""
    def listed(rows: DataFrame) -> DataFrame:
        # Fold i holds the positions from ceil(i*n/k); the one before ends fold i-1.
        ends = exact_ranks(rows.select(named(label).alias("_of"), _KEY), _KEY, "_of",
                           lambda n: [-(-i * n // k) - 1 for i in range(1, k)], few)
        kind = rows.schema[label].dataType.simpleString()
        table = rows.sparkSession.createDataFrame(list(ends.items()), f"_label {kind}, _ends array<bigint>")
        joined = rows.join(F.broadcast(table), named(label).eqNullSafe(F.col("_label")))
        fold = sum(((F.col(_KEY) > F.col("_ends")[i]).cast("int") for i in range(k - 1)), F.lit(0))
        return joined.withColumn("fold", fold).drop("_label", "_ends")

    folded = _by_label(_keyed(df, id_col, seed, method), label, few, listed,
                       lambda place, n: F.floor(place * k / n).cast("int"), "fold")
    return folded.drop(_KEY)


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42,
                method: str = "xxhash64", few: int = FEW_VALUES) -> DataFrame:
    """``n`` rows by seeded hash, or all of them if there are no more."""
    if n <= 0:
        return df.limit(0)
    low = _lowest(_keyed(df, id_col, seed, method), lambda rows: min(n, rows), few)
    return low.filter(F.col("_low")).drop(_KEY, "_low")
