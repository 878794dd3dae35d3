"""Flow captures as CSV files whose headers may differ."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowrisk.functions.numeric import number
from flowrisk.operators.clean import distinct_names, stripped

# Texts that stand for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

def _has_files(spark: SparkSession, folder: str, pattern: str) -> bool:
    files = _listed(spark, folder, pattern)
    return files is not None and not files.isEmpty()


def csv_paths(spark: SparkSession, folder: str, pattern: str = "*.csv") -> list[str]:
    """All files named like ``pattern`` under ``folder``, at any depth, sorted. Only lists, reads no content."""
    files = _listed(spark, folder, pattern)
    return [] if files is None else sorted(r["path"] for r in files.collect())


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    reader = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
    )
    try:
        return reader.load(folder).select("path")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def csv_headers(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files by header: ``header`` (the first line that is not blank), ``paths`` and ``n_files``.

    One job over all files. The text reader gives lines with their file and place, and of
    each file only the first line is kept, before anything is shuffled. A file of blank
    lines has the header NULL. Header lines must not contain quoted line ends.
    """
    meta = F.col("_metadata")
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder)
        .select(meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), "value",
                F.monotonically_increasing_id().alias("line"))
        .withColumn("value", F.regexp_replace("value", "^\ufeff|\r$", ""))
    )
    # Ids rise within a file's block; the first block with a line that is not blank holds the header.
    place = F.when(stripped(F.col("value")) != "", F.struct("block", "line", "value"))
    first = lines.groupBy("path").agg(F.min(place).alias("first"))
    return first.groupBy(F.col("first.value").alias("header")).agg(
        F.sort_array(F.collect_list("path")).alias("paths"), F.count(F.lit(1)).alias("n_files"))


def read_csv_folder(spark: SparkSession, folder: str,
                    types: Mapping[str, str] | None = None, multi_line: bool = False,
                    pattern: str = "*.csv") -> DataFrame:
    """All CSV files of a folder as one table, columns matched by name.

    A read of many CSV files matches columns by position, so files are read per
    distinct header and united by name. ``types`` maps trimmed names to the type they
    are read as, with unparsable text as NULL; without it, columns where every value
    is a number become DOUBLE or BIGINT. Quotes inside quoted text are doubled, blank
    lines count for nothing, a row that repeats the header is a row, and ``multi_line`` allows line ends inside quoted text (a
    file is then read by one task). A file without any line that is not blank is an error.
    """
    groups = csv_headers(spark, folder, pattern).collect() if _has_files(spark, folder, pattern) else []  # a row per header
    if not groups:
        raise FileNotFoundError(f"no CSV file under {folder}")
    parts = []
    for group in sorted(groups, key=lambda g: (g["header"] is None, g["paths"])):
        if group["header"] is None:
            raise ValueError(f"no header in {group['paths'][0]} and {group['n_files'] - 1} more files")
        header = distinct_names(next(csv.reader([group["header"]])))
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        part = (
            spark.read.schema(schema).option("escape", '"').option("multiLine", multi_line)
            # Of each file the first line that is not blank is taken off, and no other.
            .option("header", "true").option("enforceSchema", "true").csv(group["paths"])
        )
        parts.append(part.select(*[
            F.when(~stripped(part[f"`{c}`"]).isin(MISSING_TEXTS), part[f"`{c}`"]).alias(c) for c in header
        ]))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if types is None:
        return infer_numbers(df)
    return df.select(*[
        F.col(f"`{c}`").try_cast(types[c.strip()]).alias(c) if c.strip() in types else F.col(f"`{c}`")
        for c in df.columns
    ])


def infer_numbers(df: DataFrame) -> DataFrame:
    """Text columns that hold only numbers as DOUBLE, or as BIGINT when whole and complete.

    One scan decides for all columns. ``inf`` counts as a number and becomes NULL.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    q = {c: F.col(f"`{c}`") for c in texts}
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[
        agg for i, c in enumerate(texts) for agg in (
            F.count(q[c]).alias(f"n_{i}"),
            F.count(q[c].try_cast("double")).alias(f"number_{i}"),
            F.count(q[c].try_cast("bigint")).alias(f"whole_{i}"),
        )
    ]).first()
    new = {}
    for i, c in enumerate(texts):
        if row[f"whole_{i}"] == row["rows"] > 0:
            new[c] = q[c].try_cast("bigint")
        elif row[f"number_{i}"] == row[f"n_{i}"]:
            new[c] = number(q[c])
    return df.withColumns(new) if new else df
