"""Reduced results that may be broadcast or turned into literals, once their size is known."""

from pyspark.sql import DataFrame, Row

# Rows a reduced table may have to be brought to the driver or broadcast.
SMALL_ROWS = 10_000


def small_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list[Row] | None:
    """The rows of ``df`` if there are at most ``limit``, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None
