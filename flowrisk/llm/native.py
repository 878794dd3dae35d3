"""Small helpers for operators that consist of DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def constants(values: Sequence[float], kind: str = "double") -> Column:
    """An array of constants as one literal."""
    text = F.lit(",".join(repr(v) for v in values))
    return F.split(text, ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")
