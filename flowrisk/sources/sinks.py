"""Exports: datasets, predictions, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def export_split(df: DataFrame, folder: str, fmt: str = "parquet", split: str = "split") -> None:
    """Write ``train`` and ``test`` rows to subfolders, in one pass over the rows."""
    df.write.mode("overwrite").partitionBy(split).format(fmt).options(
        **({"header": "true"} if fmt == "csv" else {})).save(folder)


def export_predictions(scored: DataFrame, folder: str, fmt: str = "csv") -> None:
    """Input columns and result columns; nested columns go to CSV as JSON text."""
    if fmt == "csv":
        nested = [f.name for f in scored.schema if f.dataType.typeName() in ("map", "array", "struct")]
        scored = scored.withColumns({c: F.to_json(F.col(c)) for c in nested}) if nested else scored
    scored.write.mode("overwrite").format(fmt).options(
        **({"header": "true"} if fmt == "csv" else {})).save(folder)


def export_json(report: DataFrame, folder: str) -> None:
    """A report of few rows as one JSON-lines file."""
    report.coalesce(1).write.mode("overwrite").json(folder)
