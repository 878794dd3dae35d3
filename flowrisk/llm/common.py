"""What the operators share: the word pattern, row keys that survive nulls and repeats, table reading."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality on all ``names``."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in names])


def with_table(rows: DataFrame, side: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined null-safely to ``side``; each column of ``names`` stays once, from ``rows``."""
    side = side.withColumnsRenamed({c: f"_{c}_" for c in names})
    on = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(side[f"_{c}_"]) for c in names])
    return rows.join(side, on, how).drop(*[f"_{c}_" for c in names])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
