"""Secret scans: fixed patterns, and character Markov models, in DataFrame functions alone.

The patterns find assignments, access keys and hexadecimal strings. Beside them every
long run of key characters is judged by two first-order Markov models of its characters,
one of random strings and one of ordinary identifiers: the log-likelihood ratio of the
run must reach ``LEAST_RATIO``. Both models are counts of character pairs from labelled
samples, smoothed; they have one number per pair of printable ASCII characters.

A span is (start, stop, kind) in code points, stop exclusive. Runs that overlap a span of
a pattern are not reported again.

Defined cases: null and empty texts have no spans; a model without samples of either
label finds nothing; rows are judged one by one, so equal rows and ids get equal results;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowrisk.llm.common import WORD
from flowrisk.llm.native import constants, let

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_VALUE = 12
RUN = r"[A-Za-z0-9+/_=-]{16,}"
LEAST_RATIO = 10.0   # nats: the odds of a false find are those of a rare event

# Bounds of the samples the models are fitted on.
RANDOM_SAMPLES = 20_000
ORDINARY_DOCUMENTS = 2_000
_FIRST, _SYMBOLS = 32, 95
_BLOCK = 256


def _matches(text: Column, pattern: str, kind: int, value: int = 0) -> Column:
    """Array of (start, kind, stop, value) of the leftmost matches, whole or empty.

    Places follow from the lengths of the matches and of the pieces between them, summed
    in blocks so that a text with very many matches stays cheap.
    """
    def located(found: Column, pieces: Column, values: Column) -> Column:
        steps = F.transform(found, lambda m, i: (F.length(m) + F.length(F.get(pieces, i))).cast("long"))

        def total(xs: Column) -> Column:
            return F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x)

        def placed(by: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(by) - 1) / _BLOCK).cast("int")),
                                 lambda b: total(F.slice(by, b * _BLOCK + 1, F.lit(_BLOCK))))

            def each(sums: Column) -> Column:
                def span(m: Column, i: Column) -> Column:
                    block = F.floor(i / _BLOCK).cast("int")
                    stop = (total(F.slice(sums, F.lit(1), block))
                            + total(F.slice(by, block * _BLOCK + 1, i - block * _BLOCK + 1)))
                    return F.struct((stop - F.length(m)).alias("start"), F.lit(kind).alias("kind"),
                                    stop.alias("stop"), F.get(values, i).alias("value"))
                return F.transform(found, span)

            return let(blocks, each)

        return let(steps, placed)

    kind_of_none = "array<struct<start: bigint, kind: int, stop: bigint, value: string>>"
    none = F.array().cast(kind_of_none)
    hits = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: let(
        F.split(text, pattern, -1), lambda pieces: let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(value)) if value else found,
            lambda values: F.when(F.size(found) > 0, located(found, pieces, values)).otherwise(none))))
    return F.when(F.rlike(text, F.lit(pattern)), hits).otherwise(none)


def pattern_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and then kind."""
    assign = F.filter(_matches(text, ASSIGN, 0, value=2), lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    return F.array_sort(F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2)))


def _pairs(text: Column) -> Column:
    """Numbers of the pairs of neighbouring characters of a printable ASCII string."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) - _FIRST)
    return let(codes, lambda cs: F.transform(
        F.sequence(F.lit(1), F.size(cs) - 1), lambda i: F.get(cs, i - 1) * _SYMBOLS + F.get(cs, i)))


def labelled_samples(docs: DataFrame, random: int = RANDOM_SAMPLES, documents: int = ORDINARY_DOCUMENTS) -> DataFrame:
    """Samples (text, random): what the patterns found, and the words of documents outside of it.

    Both are bounded draws by hash: at most ``random`` strings found, and the words of at
    most ``documents`` documents, the same on every run.
    """
    text = F.coalesce("text", F.lit(""))
    found = (
        docs.select(F.explode(pattern_spans(text)).alias("s")).select(F.col("s.value").alias("text"))
        .filter(F.col("text").isNotNull()).distinct()
        .orderBy(F.xxhash64("text"), "text").limit(random)
    )
    # Only about thrice as many rows as wanted are ordered, those of the smallest hashes.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    share = min(1.0, (3 * documents + 100) / max(docs.count(), 1))
    some = docs.select("doc_id", text.alias("text")).filter(place < int(share * (1 << 32)))
    some = some.orderBy(place, "doc_id", "text").limit(documents)
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    words = (
        some.select(F.explode(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))).alias("text"))
        .select(F.regexp_extract("text", r"[!-~]{4,}", 0).alias("text")).filter("text <> ''")
    )
    return found.withColumn("random", F.lit(True)).unionByName(words.withColumn("random", F.lit(False)))


def fit(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """The log-likelihood ratio of every pair of characters, random over ordinary."""
    printable = samples.filter(F.length("text") > 1).filter(F.rlike("text", F.lit(r"^[ -~]+$")))
    rows = printable.select("random", F.explode(_pairs(F.col("text"))).alias("pair")).groupBy("random", "pair").count()
    counts = {True: [0.0] * _SYMBOLS ** 2, False: [0.0] * _SYMBOLS ** 2}
    for row in rows.collect():  # at most 2 * 95 ** 2 rows
        counts[row["random"]][row["pair"]] = float(row["count"])
    if not any(counts[True]) or not any(counts[False]):
        return []
    logs = {}
    for label, of in counts.items():
        logs[label] = []
        for a in range(_SYMBOLS):
            row = of[a * _SYMBOLS:(a + 1) * _SYMBOLS]
            logs[label] += [math.log((c + smooth) / (sum(row) + smooth * _SYMBOLS)) for c in row]
    return [round(r - o, 6) for r, o in zip(logs[True], logs[False])]


def ratio(text: Column, model: Sequence[float]) -> Column:
    table = constants(model)
    return F.aggregate(_pairs(text), F.lit(0.0), lambda s, p: s + F.get(table, p))


def all_spans(text: Column, model: Sequence[float], least: float = LEAST_RATIO) -> Column:
    """Spans of the patterns and of the models, by start and then kind."""
    def both(base: Column) -> Column:
        if not model:
            return base
        runs = F.filter(_matches(text, RUN, 3), lambda r: ratio(r["value"], model) >= least)
        new = F.filter(runs, lambda r: ~F.exists(base, lambda s: (s["start"] < r["stop"]) & (r["start"] < s["stop"])))
        return F.array_sort(F.concat(base, new))

    return let(pattern_spans(text), both)


def scan(docs: DataFrame, model: Sequence[float], least: float = LEAST_RATIO) -> DataFrame:
    """doc_id, text and ``found``, the array of (start, kind, stop, value), per row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("found", all_spans(F.col("text"), model, least))


def listed(found: Column) -> Column:
    """Spans as kind:start:stop, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced; spans that overlap are replaced as one."""
    none = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda acc, s: F.when(s["stop"] <= acc["at"], acc).otherwise(F.struct(
        s["stop"].alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))).alias("out")))
    done = F.aggregate(found, none, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(found) > 0, done).otherwise(text)
