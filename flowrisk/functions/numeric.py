"""Numeric coercion, null handling and rounding as column expressions."""

from pyspark.sql import Column, functions as F


def named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def finite(c: Column) -> Column:
    """NaN and both infinities become NULL, so that NULL is the only missing value."""
    c = c.cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def number(c: Column) -> Column:
    """Text or numeric column as finite DOUBLE; what does not parse is NULL."""
    return finite(c.try_cast("double"))


def half_up(c: Column, digits: int) -> Column:
    """Round by ``floor(x * 10^d + 0.5) / 10^d``, the same rule in every SQL engine."""
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), c))


def settled(c: Column) -> Column:
    """Without the digits that depend on the order of additions, so that thresholds and
    rounding decide alike in a batch, in slices and in a stream."""
    return half_up(c, 9)
