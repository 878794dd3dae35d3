"""Learned preprocessing: medians, scaling and one-hot columns as plain projections."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowrisk.functions.numeric import named, number
from flowrisk.operators.clean import numeric_columns
from flowrisk.operators.explore import label_encode
from flowrisk.operators.order_stats import FEW_VALUES, exact_quantiles
from flowrisk.schema import CATEGORICAL_COLUMNS

MISSING = "missing"


@dataclass(frozen=True)
class NumericStats:
    """Median of the values present; mean and population deviation after imputation."""

    median: float
    mean: float
    std: float


@dataclass(frozen=True)
class FitStats:
    numeric: dict[str, NumericStats]
    categories: dict[str, list[str]]

    @property
    def feature_names(self) -> list[str]:
        onehot = [f"{c}_{v}" for c, values in self.categories.items() for v in values]
        return [*self.numeric, *onehot]

    def imputed(self, df: DataFrame, name: str) -> Column:
        """Column with missing values replaced; one absent from ``df`` is all median."""
        median = F.lit(self.numeric[name].median)
        return F.coalesce(number(named(name)), median) if name in df.columns else median

    def columns(self, df: DataFrame) -> list[Column]:
        """The scaled numeric columns, then one 0/1 column per category."""
        scaled = [
            ((self.imputed(df, c) - s.mean) / (s.std or 1.0)).alias(c)
            for c, s in self.numeric.items()
        ]
        onehot = [
            (_category(df, c) == v).cast("double").alias(f"{c}_{v}")
            for c, values in self.categories.items() for v in values
        ]
        return scaled + onehot

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """Append the feature vector; a category not seen in fitting is all zeros."""
        columns = self.columns(df)
        if not columns:
            raise ValueError("no numeric or categorical feature to assemble")
        return df.withColumn(out, array_to_vector(F.array(*columns)))

    def to_json(self) -> str:
        return json.dumps({"numeric": {c: asdict(s) for c, s in self.numeric.items()},
                           "categories": self.categories})

    @staticmethod
    def from_json(text: str) -> FitStats:
        raw = json.loads(text)
        return FitStats({c: NumericStats(**s) for c, s in raw["numeric"].items()}, raw["categories"])


def _category(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(MISSING)
    return F.coalesce(named(name).cast("string"), F.lit(MISSING))


def one_hot_vectors(df: DataFrame, name: str, out: str) -> DataFrame:
    """``out``: the category of ``name`` as a sparse 0/1 vector, categories in alphabetical order.

    The table of categories stays distributed and the column names none of them, so there
    may be any number; a missing value is the category ``missing``.
    """
    coded = label_encode(df.withColumn("_category", _category(df, name)), "_category", "_code")
    size = (coded.agg(F.max("_code")).first()[0] or 0) + 1
    # An encoder would list a name per category in the column's metadata, on the driver.
    text = F.format_string(f'{{"v":{{"type":0,"size":{size},"indices":[%d],"values":[1.0]}}}}', "_code")
    vector = F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]
    return coded.withColumn(out, vector.alias(out, metadata={"ml_attr": {"num_attrs": size}})).drop("_category", "_code")


def active_columns(df: DataFrame, categorical: Sequence[str] = CATEGORICAL_COLUMNS,
                   exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Categorical columns present, and all other numeric columns in table order."""
    cats = [c for c in categorical if c in df.columns and c not in exclude]
    nums = [c for c in numeric_columns(df) if c not in cats and c not in exclude]
    return cats, nums


def fit_stats(df: DataFrame, categorical: Sequence[str] = CATEGORICAL_COLUMNS,
              exclude: Sequence[str] = (), few: int = FEW_VALUES, only: Sequence[str] | None = None) -> FitStats:
    """Learn medians, scaling and categories of ``df``, or of the columns ``only``.

    Moments are taken over the raw values; imputing u values at the median m shifts
    them by a closed formula, so the imputed table is never scanned.
    """
    cats, nums = active_columns(df, categorical, exclude)
    if only is not None:
        cats, nums = [c for c in cats if c in only], [c for c in nums if c in only]
    numeric: dict[str, NumericStats] = {}
    if nums:
        values = df.select(*[number(named(c)).alias(c) for c in nums])
        row = values.agg(F.count(F.lit(1)).alias("_rows"), *[
            agg for i, c in enumerate(nums) for agg in (
                F.count(named(c)).alias(f"n_{i}"), F.min(named(c)).alias(f"lo_{i}"), F.max(named(c)).alias(f"hi_{i}"),
                F.avg(named(c)).alias(f"avg_{i}"), F.var_pop(named(c)).alias(f"var_{i}"))
        ]).first()
        extent = {c: (row[f"n_{i}"], row[f"lo_{i}"], row[f"hi_{i}"]) for i, c in enumerate(nums)}
        medians = exact_quantiles(values, nums, 0.5, few, extent)
        for i, c in enumerate(nums):
            median = medians[c] if medians[c] is not None else 0.0
            numeric[c] = _after_imputing(
                median, row["_rows"], row[f"n_{i}"], row[f"avg_{i}"], row[f"var_{i}"])
    categories: dict[str, list[str]] = {}
    if cats:
        pairs = F.array(*[F.struct(F.lit(c).alias("c"), _category(df, c).alias("v")) for c in cats])
        # Feature names are a list on the driver, one per category; `one_hot_vectors` needs none.
        seen = df.select(F.explode(pairs).alias("x")).select("x.*").distinct().collect()
        categories = {c: sorted(r["v"] for r in seen if r["c"] == c) for c in cats}
    return FitStats(numeric, categories)


def _after_imputing(median: float, rows: int, n: int, avg: float | None, var: float | None) -> NumericStats:
    if n == 0:
        return NumericStats(median, median, 0.0)
    missing = rows - n
    mean = (n * avg + missing * median) / rows
    spread = n * var + n * (avg - mean) ** 2 + missing * (median - mean) ** 2
    std = math.sqrt(spread / rows)
    # Rounding noise around a constant is no spread.
    return NumericStats(median, mean, std if std > 1e-12 * abs(mean) else 0.0)
