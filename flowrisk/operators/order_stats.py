"""Exact order statistics without sorting the table or gathering its values.

`percentile` keeps every distinct value of a column in one task. Here each wanted
position is enclosed in a range of values. A round cuts the range into bins, counts
them with map-side combine, and goes on with the bin that holds the position. Once a
range holds few rows, or a single value, its values are counted one by one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowrisk.functions.numeric import finite, named

# Ranges with at most this many rows are counted out, up to this many in one task.
FEW_VALUES = 200_000
BINS = 65_536


@dataclass(frozen=True)
class Bracket:
    """Values low..high enclose the sorted positions first..last of one group's column."""

    first: int
    last: int
    low: object
    high: object
    below: int   # rows under low
    inside: int  # rows from low to high


def exact_quantiles(df: DataFrame, columns: Sequence[str], probability: float,
                    few: int = FEW_VALUES, extent: dict | None = None) -> dict[str, float | None]:
    """Linearly interpolated quantile of each column's non-null values; None if it has none.

    ``extent`` gives each column's (values, least, greatest) where they are known.
    """
    columns = list(columns)
    if not columns:
        return {}
    values = df.select(*[finite(named(c)).alias(c) for c in columns])
    extent = extent or {c: e for (_, c), e in _extent(values, None, columns).items()}
    brackets, part = {}, {}
    for c, (n, low, high) in extent.items():
        at = probability * (n - 1)
        if n:
            brackets[None, c, 0] = Bracket(math.floor(at), math.ceil(at), low, high, 0, n)
            part[c] = at - math.floor(at)
    found = _select(values, None, columns, brackets, few)
    result: dict[str, float | None] = dict.fromkeys(columns)
    for c, share in part.items():
        low, high = found[None, c, 0]
        result[c] = low + (high - low) * share
    return result


def exact_ranks(df: DataFrame, value: str, group: str | None,
                ranks: Callable[[int], Sequence[int]], few: int = FEW_VALUES) -> dict:
    """Values at the 0-based sorted positions ``ranks(rows)`` of each group.

    Returns ``{group value: [value, ...]}``, with the key None when there is no group.
    Every group must ask for the same number of positions; all groups are brought to the
    driver, so there should be few: `splits` ranks small groups in place.
    """
    brackets = {
        (g, value, t): Bracket(rank, rank, low, high, 0, n)
        for (g, _), (n, low, high) in _extent(df, group, [value]).items() if n
        for t, rank in enumerate(ranks(n))
    }
    found = _select(df, group, [value], brackets, few)
    result: dict = {}
    for g, _, t in sorted(brackets, key=lambda k: k[2]):
        result.setdefault(g, []).append(found[g, value, t][0])
    return result


def _extent(df, group, columns) -> dict:
    """``{(group, column): (values, least, greatest)}``; callers see to it that groups are few."""
    keys = [group] if group else []
    extent = df.groupBy(*keys).agg(*[
        f(named(c)).alias(f"{name}_{i}")
        for i, c in enumerate(columns)
        for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))
    ])
    return {
        (row[group] if group else None, c): (row[f"n_{i}"], row[f"lo_{i}"], row[f"hi_{i}"])
        for row in extent.collect() for i, c in enumerate(columns)
    }


def _select(df, group, columns, brackets: dict[tuple, Bracket], few: int) -> dict:
    """``{(group, column, target): (value at first, value at last)}`` for each bracket."""
    brackets = dict(brackets)
    while True:
        wide = {k: b for k, b in brackets.items() if b.inside > few and b.low < b.high}
        if not wide:
            break
        narrowed = _pieces(df, group, columns, wide, binned=True)
        brackets.update(narrowed)
        if all(narrowed[k].inside == b.inside for k, b in wide.items()):
            break  # closer than the bins can tell apart
    spread = {k: b for k, b in brackets.items() if b.low < b.high}
    if spread:
        brackets.update(_pieces(df, group, columns, spread, binned=False))
    return {k: (b.low, b.high) for k, b in brackets.items()}


def _pieces(df, group, columns, brackets, binned: bool) -> dict[tuple, Bracket]:
    """Each bracket shrunk to the bins, or to the values, that hold its positions."""
    spans = _disjoint(brackets)
    rows = _in_spans(df, group, columns, spans)
    keys = ([group] if group else []) + ["i", "j"]
    piece = F.col("v")
    if binned:
        share = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
        piece = F.least(F.floor(share * BINS), F.lit(BINS - 1))
    counted = rows.groupBy(*keys, piece.alias("piece")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    # Bins or few values of one span are ordered in one task.
    upto = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("upto", F.sum("n").over(upto))
    asked = [
        (g, columns.index(c), j, t, brackets[g, c, t].first - below, brackets[g, c, t].last - below)
        for (g, c), found in spans.items() for j, (_, _, below, targets) in enumerate(found) for t in targets
    ]
    kind = df.schema[group].dataType.simpleString() if group else "string"
    wanted = F.broadcast(df.sparkSession.createDataFrame(
        asked, f"_g {kind}, _i int, _j int, t int, first bigint, last bigint"))  # one row per target
    same = (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j"))
    if group:
        same &= F.col(group).eqNullSafe(F.col("_g"))
    hits = counted.join(
        wanted, same & (F.col("upto") > F.col("first")) & (F.col("upto") - F.col("n") <= F.col("last")))
    found: dict[tuple, list] = {}
    for row in hits.select("_g", "i", "j", "t", "least", "most", "n", "upto").collect():
        found.setdefault((row["_g"], columns[row["i"]], row["t"]), []).append(row)
    result = {}
    for key, hit in found.items():
        hit.sort(key=lambda r: r["least"])
        below = spans[key[:2]][hit[0]["j"]][2] + hit[0]["upto"] - hit[0]["n"]
        b = brackets[key]
        result[key] = Bracket(b.first, b.last, hit[0]["least"], hit[-1]["most"], below,
                              sum(r["n"] for r in hit))
    return result


def _disjoint(brackets: dict[tuple, Bracket]) -> dict[tuple, list]:
    """``{(group, column): [[low, high, rows below, targets], ...]}``, overlaps merged."""
    spans: dict[tuple, list] = {}
    for (g, c, t), b in sorted(brackets.items(), key=lambda item: item[1].low):
        found = spans.setdefault((g, c), [])
        if found and b.low <= found[-1][1]:
            found[-1][1] = max(found[-1][1], b.high)
            found[-1][3].append(t)
        else:
            found.append([b.low, b.high, b.below, [t]])
    return spans


def _in_spans(df, group, columns, spans) -> DataFrame:
    """One row per value inside a span: group, column ``i``, span ``j`` with its ends, value ``v``."""
    most = max(map(len, spans.values()))
    if group:
        kind, of = df.schema[columns[0]].dataType.simpleString(), df.schema[group].dataType.simpleString()
        ends = f"array<struct<j:int,low:{kind},high:{kind}>>"
        table = [(g, [(j, s[0], s[1]) for j, s in enumerate(found)]) for (g, _), found in spans.items()]
        bounds = F.broadcast(df.sparkSession.createDataFrame(table, f"_g {of}, _spans {ends}"))  # one row per group
        df = df.join(bounds, F.col(group).eqNullSafe(F.col("_g")))

        def span(c: str, j: int) -> Column:
            return F.get("_spans", F.lit(j))
    else:
        def span(c: str, j: int) -> Column | None:
            found = spans.get((None, c), [])
            if j >= len(found):
                return None
            low, high = found[j][:2]
            return F.struct(F.lit(j).alias("j"), F.lit(low).alias("low"), F.lit(high).alias("high"))

    def place(i: int, c: str) -> Column:
        ends = [e for e in (span(c, j) for j in range(most)) if e is not None]
        inside = [F.when((named(c) >= e["low"]) & (named(c) <= e["high"]), e) for e in ends]
        return F.struct(F.lit(i).alias("i"), F.coalesce(*inside).alias("s"), named(c).alias("v"))

    places = [place(i, c) for i, c in enumerate(columns) if any(key[1] == c for key in spans)]
    keys = [group] if group else []
    values = df.select(*keys, (places[0] if len(places) == 1 else F.explode(F.array(*places))).alias("x"))
    return values.filter(F.col("x.s").isNotNull()).select(*keys, "x.i", "x.s.*", "x.v")
