"""Cleaning: header and label hygiene, missing values, column selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowrisk.functions.numeric import finite, named, number
from flowrisk.schema import ATTACK_CATEGORIES, BASELINE_LEAK_COLUMNS, LEAK_COLUMNS


# All characters that count as white space at the ends of a text.
WHITE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def distinct_names(names: Iterable[str]) -> list[str]:
    """The names, a repeated one with ``.1``, ``.2``, ... behind it."""
    names = list(names)
    taken, out = set(names), []
    for i, name in enumerate(names):
        n = 0
        while (name in names[:i]) if n == 0 else (f"{name}.{n}" in taken):
            n += 1
        out.append(f"{name}.{n}" if n else name)
        taken.add(out[-1])
    return out


def trim_names(df: DataFrame) -> DataFrame:
    """Names without white space at their ends; names that become equal are numbered."""
    return df.toDF(*distinct_names(c.strip() for c in df.columns))


def find_target(df: DataFrame, target: str = "label") -> str | None:
    """First column named ``target``, ignoring case and surrounding spaces."""
    return next((c for c in df.columns if c.strip().lower() == target.lower()), None)


def trim_label(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(label, stripped(named(label).cast("string")))


def non_finite_to_null(df: DataFrame) -> DataFrame:
    """NaN and infinities of every floating-point column become NULL."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(named(c)) for c in floats}) if floats else df


def leak_columns(df: DataFrame, leaks: Iterable[str], normalize_underscores: bool = False) -> list[str]:
    """Columns whose trimmed lower-case name is a known identifier.

    The lists spell names with spaces; ``normalize_underscores`` also matches ``src_ip``.
    """
    leaks = set(leaks)

    def key(name: str) -> str:
        name = name.strip().lower()
        return name.replace("_", " ") if normalize_underscores else name

    return [c for c in df.columns if key(c) in leaks]


def _without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[named(c) for c in df.columns if c not in columns])


def clean_flows(df: DataFrame, training: bool = False, target: str = "label",
                leaks: Sequence[str] = LEAK_COLUMNS, normalize_underscores: bool = False,
                keep: Sequence[str] = ()) -> DataFrame:
    """Trim names and labels, unify missing values, drop identifier columns.

    In training, rows without a label go. ``keep`` names identifier columns to carry
    along, such as the order of a trend.
    """
    df = trim_names(df)
    label = find_target(df, target)
    if label is not None:
        df = trim_label(df, label)
        if training:
            df = df.filter(named(label).isNotNull())
    df = non_finite_to_null(df)
    return _without(df, [c for c in leak_columns(df, leaks, normalize_underscores) if c not in keep])


def split_target(df: DataFrame, target: str = "label") -> tuple[list[str], str | None]:
    """Feature column names and the target's name; the rows stay in one DataFrame."""
    label = find_target(df, target)
    return [c for c in df.columns if c != label], label


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct non-null value, by one min/max aggregate."""
    if not columns:
        return []
    row = df.agg(*[
        F.min(named(c)).eqNullSafe(F.max(named(c))) for c in columns
    ]).first()
    return [c for c, constant in zip(columns, row) if constant]


def clean_baseline(df: DataFrame, leaks: Sequence[str] = BASELINE_LEAK_COLUMNS,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Cleaning for the numeric-only baseline classifier.

    Every row with a missing value goes first, even where the column is dropped later;
    then identifier, non-numeric and constant columns go.
    """
    df = trim_names(df)
    label = find_target(df)
    if label is None:
        raise ValueError(f"no label column among {df.columns}")
    df = non_finite_to_null(trim_label(df, label))
    df = df.filter(reduce(and_, [named(c).isNotNull() for c in df.columns]))
    df = _without(df, [c for c in leak_columns(df, leaks) if c not in keep])
    numeric = [c for c in numeric_columns(df) if c not in (label, *keep)]
    constant = set(constant_columns(df, numeric))
    return df.select(*map(named, [*keep, *[c for c in numeric if c not in constant], label]))


def dropped_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row with the row counts before and after a cleaning step."""
    n_before = before.agg(F.count(F.lit(1)).alias("rows_before"))
    n_after = after.agg(F.count(F.lit(1))).scalar()
    return n_before.withColumn("rows_after", n_after).withColumn(
        "rows_dropped", F.col("rows_before") - F.col("rows_after"))


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as DOUBLE, unparsable text as NULL."""
    return df.withColumns({c: number(named(c)) for c in columns})


def fill(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(named(c), F.lit(v)) for c, v in values.items()})


def first_rows(df: DataFrame, order: Sequence[str], n: int | None) -> DataFrame:
    """The first ``n`` rows in ``order``; 0 or None keeps all."""
    return df.orderBy(*order).limit(n) if n else df


def attack_category(df: DataFrame, name: str, out: str = "attack_category",
                    categories: dict[str, str] = ATTACK_CATEGORIES) -> DataFrame:
    """Category of a raw attack name by an exact lower-case match, else ``Other``."""
    items = [F.lit(x) for pair in categories.items() for x in pair]
    found = F.try_element_at(F.create_map(*items), F.lower(stripped(F.col(name))))
    return df.withColumn(out, F.coalesce(found, F.lit("Other")))


def search(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the columns contains ``text``, ignoring case."""
    hit = [F.lower(named(c).cast("string")).contains(text.lower()) for c in columns]
    return df.filter(F.coalesce(F.array_contains(F.array(*hit), True), F.lit(False)))


def traffic_filter(df: DataFrame, kind: str = "all", label: str = "predicted_label") -> DataFrame:
    """``all``, ``threats``, ``safe`` or the name of one class."""
    if kind == "all":
        return df
    if kind == "threats":
        return df.filter(F.col("is_attack"))
    if kind == "safe":
        return df.filter(~F.col("is_attack"))
    return df.filter(F.col(label) == kind)
