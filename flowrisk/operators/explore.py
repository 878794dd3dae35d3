"""Exploration of a flow table: distributions, cross-tabs, histograms, correlations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from flowrisk.functions.numeric import named
from flowrisk.operators.clean import numeric_columns
from flowrisk.operators.ordered import KeyOrder
from flowrisk.operators.order_stats import FEW_VALUES, exact_quantiles
from flowrisk.operators.small import small_rows


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), column)


def drop_rare_classes(df: DataFrame, label: str, least: int = 50) -> DataFrame:
    """Rows whose class has at least ``least`` rows."""
    kept = (
        df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") >= least) & F.col(label).isNotNull()).select(label)
    )
    rows = small_rows(kept)
    if rows is None:
        return df.join(kept, label, "left_semi")
    return df.filter(F.col(label).isin([r[label] for r in rows]))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    per_class = counts.agg(F.sum("n") / F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", per_class / F.col("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts of ``row`` by ``column``; values of ``column`` become columns, sorted.

    `crosstab_long` is the form for more values than a table should have columns.
    """
    if values is None:  # the result has a column for each, so the driver has to know them
        values = sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())
    return df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def crosstab_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of ``row`` by ``column``, a row per pair that occurs."""
    return df.filter(F.col(column).isNotNull()).groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))


def correlation(df: DataFrame, columns: Sequence[str] | None = None, first: int = 20) -> DataFrame:
    """Pearson correlation of each pair of columns, below the diagonal.

    Without ``columns`` the ``first`` numeric columns are taken. A pair ignores rows
    where either side is missing.
    """
    columns = list(columns) if columns else numeric_columns(df)[:first]
    if len(columns) < 2:
        raise ValueError("a correlation needs two numeric columns")
    values = df.select(*[named(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    means = values.agg(*[F.avg(c) for c in values.columns]).first()
    shift = np.array([m if m is not None else 0.0 for m in means])

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums over the task's rows for each pair, of values taken from the mean."""
        size = len(shift)
        total = np.zeros((4, size, size))
        for batch in batches:
            v = batch.to_numpy("float64")
            there = (~np.isnan(v)).astype("float64")
            v = np.where(there > 0, v - shift, 0.0)
            total += np.stack([there.T @ there, v.T @ v, v.T @ there, (v * v).T @ there])
        a, b = np.tril_indices(size, -1)
        yield pd.DataFrame({
            "a": a, "b": b, "n": total[0, a, b], "ab": total[1, a, b],
            "sa": total[2, a, b], "sb": total[2, b, a], "aa": total[3, a, b], "bb": total[3, b, a],
        })

    # A `corr` per pair makes more generated code than the JVM compiles; one matrix
    # product per Arrow batch does all pairs, and each task hands on one row per pair.
    sums = values.mapInPandas(products, "a int, b int, " + ", ".join(
        f"{c} double" for c in ("n", "ab", "sa", "sb", "aa", "bb")))
    sums = sums.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "ab", "sa", "sb", "aa", "bb")])
    n = F.col("n")
    joint = F.col("ab") - F.col("sa") * F.col("sb") / n
    spread = (F.col("aa") - F.col("sa") * F.col("sa") / n) * (F.col("bb") - F.col("sb") * F.col("sb") / n)
    names = F.array(*map(F.lit, columns))
    return sums.select(names[F.col("a")].alias("a"), names[F.col("b")].alias("b"),
                       F.when((n > 0) & (spread > 0), joint / F.sqrt(spread)).alias("r"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width counts between least and greatest value; the last bin is closed."""
    values = df.select(named(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        low = high = 0.0
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    at = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    counts = values.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(F.broadcast(counts), "bin", "left")  # one row per bin
        .select("bin", (F.lit(low) + F.col("bin") * width).alias("low"),
                (F.lit(low) + (F.col("bin") + 1) * width).alias("high"),
                F.coalesce("n", F.lit(0)).alias("n"))
    )


def clipped_histograms(df: DataFrame, columns: Sequence[str], label: str, bins: int = 40,
                       upper: float = 0.99, few: int = FEW_VALUES) -> DataFrame:
    """Density of each column per class, clipped at the whole table's upper quantile.

    The bins of a class run from its own least to its own greatest clipped value. Only
    bins that hold rows are listed.
    """
    caps = exact_quantiles(df, columns, upper, few)
    capped = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.when(named(c).isNotNull(), F.least(named(c).cast("double"), F.lit(caps[c]))).alias("v"))
        for c in columns if caps[c] is not None
    ])
    values = (
        df.filter(F.col(label).isNotNull())
        .select(F.col(label).alias("class"), F.explode(capped).alias("x"))
        .select("class", "x.*").filter(F.col("v").isNotNull())
    )
    ranges = values.groupBy("class", "feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi"),
                                                    F.count(F.lit(1)).alias("rows"))
    ranges = ranges.withColumns({
        "low": F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")),
        "high": F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")),
    }).select("class", "feature", "rows", "low", ((F.col("high") - F.col("low")) / bins).alias("width"))
    at = F.least(F.floor((F.col("v") - F.col("low")) / F.col("width")), F.lit(bins - 1)).cast("int")
    return (
        values.join(ranges, ["class", "feature"])
        .groupBy("class", "feature", at.alias("bin"), "rows", "low", "width")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("class", "feature", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("low"),
                "n", (F.col("n") / (F.col("rows") * F.col("width"))).alias("density"))
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Kind, missing values, extremes and approximate distinct values of each column, one scan."""
    def kind(t: T.DataType) -> str:
        if isinstance(t, T.NumericType):
            return "numeric"
        return "categorical" if isinstance(t, T.StringType) else t.simpleString()

    fields = df.schema.fields
    row = df.agg(*[
        agg for i, f in enumerate(fields) for agg in (
            F.count_if(named(f.name).isNull()).alias(f"nulls_{i}"),
            F.min(named(f.name)).cast("string").alias(f"min_{i}"),
            F.max(named(f.name)).cast("string").alias(f"max_{i}"),
            F.approx_count_distinct(named(f.name)).alias(f"distinct_{i}"),
        )
    ])
    lines = [
        F.struct(F.lit(f.name).alias("column"), F.lit(kind(f.dataType)).alias("kind"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"nulls_{i}").alias("nulls"), F.col(f"min_{i}").alias("least"),
                 F.col(f"max_{i}").alias("greatest"), F.col(f"distinct_{i}").alias("approx_distinct"))
        for i, f in enumerate(fields)
    ]
    return row.select(F.explode(F.array(*lines)).alias("x")).select("x.*")


def kinds(df: DataFrame) -> DataFrame:
    """Number of columns of each type."""
    types = [(f.dataType.simpleString(),) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(types, "type string").groupBy("type").count()


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Ordinal of each value in alphabetical order, from 0; NULL stays NULL."""
    values = df.select(F.col(column).alias("_value")).filter(F.col(column).isNotNull()).distinct()
    rows = small_rows(values)  # few codes are sent along, more are joined; the result is the same
    if rows is not None:
        listed = sorted(r["_value"] for r in rows)
        codes = df.sparkSession.createDataFrame(
            list(zip(listed, range(len(listed)))), f"_value {df.schema[column].dataType.simpleString()}, {out} bigint")
        codes = F.broadcast(codes)  # at most SMALL_ROWS rows
    else:
        one = values.withColumn("_one", F.lit(1).cast("bigint"))
        numbered = KeyOrder.of(one, [], ["_value"]).running_sum("_one", out).rows()
        codes = numbered.withColumn(out, F.col(out) - 1).drop("_one")
        # Missing values match nothing and would all meet in one task.
        there = df.filter(F.col(column).isNotNull()).join(codes, F.col(column) == F.col("_value")).drop("_value")
        return there.unionByName(df.filter(F.col(column).isNull()).withColumn(out, F.lit(None).cast("bigint")))
    return df.join(codes, F.col(column) == F.col("_value"), "left").drop("_value")
