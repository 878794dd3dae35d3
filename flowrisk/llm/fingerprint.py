"""Document fingerprints by one-permutation MinHash, in DataFrame functions alone.

Every five-word shingle is hashed once; the high bits of the hash name one of ``BINS``
bins and each bin keeps its smallest hash. An empty bin takes the hash of another one
that is not empty, found by probing with a hash of its own number, the optimal
densification: any two documents probe in the same order, and each empty bin draws
independently. A fingerprint packs the low ``BITS`` bits of every bin; as two different
hashes agree on them with probability 2 ** -BITS, the share of equal bins is corrected
for that.

Defined cases: null and empty texts, and texts of white space, have no shingle and the
empty fingerprint, which is like itself (1) and unlike any other (0); texts under five
words are one shingle; rows with equal ids are ordered by text, null ids come last; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowrisk.llm.common import partitions
from flowrisk.llm.native import constants, let

WORDS = 5
BINS = 128
BITS = 8
PROBES = 6


def shingle_hashes(text: Column) -> Column:
    """One hash per word of ``text`` that starts a shingle."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashes(ws: Column) -> Column:
        starts = F.slice(ws, F.lit(1), F.greatest(F.size(ws) - WORDS + 1, F.lit(1)))
        return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, WORDS)]))

    return let(words, hashes)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - (BINS - 1).bit_length()).cast("int")


def _densified(first: Column) -> Column:
    """The smallest hash of every bin, given those of the bins that are not empty."""
    def fill(by_bin: Column) -> Column:
        def value(i: Column) -> Column:
            probes = [F.try_element_at(by_bin, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int"))
                      for t in range(PROBES)]
            # Where all probes met empty bins: the one that is smallest in an order of the bin's own.
            rest = F.array_min(F.transform(F.map_entries(by_bin), lambda e: F.struct(
                F.xxhash64(i, e["key"], F.lit(PROBES)).alias("rank"), e["value"].alias("value"))))
            return F.coalesce(F.try_element_at(by_bin, i), *probes, rest["value"])

        return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)

    return let(F.map_from_arrays(F.transform(first, _bin), first), fill)


def packed_bins(text: Column) -> Column:
    """The low bits of all bins, as an array; empty for a text without shingles."""
    def smallest(hashes: Column) -> Column:
        return F.filter(hashes, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(hashes, i - 1))))

    def low(first: Column) -> Column:
        bits = F.transform(_densified(first), lambda v: v.bitwiseAND(F.lit((1 << BITS) - 1)).cast("short"))
        return F.when(F.size(first) > 0, bits).otherwise(F.array().cast("array<smallint>"))

    return let(let(F.sort_array(shingle_hashes(text)), smallest), low)


def as_text(bins: Column) -> Column:
    digits = -(-BITS // 4)
    return F.array_join(F.transform(bins, lambda b: F.lpad(F.lower(F.hex(b.cast("long"))), digits, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, corrected for bins that agree by chance."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    corrected = F.greatest(F.lit(0.0), (equal / F.lit(BINS) - chance) / (1 - chance))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(corrected))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``bins`` per row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("bins", packed_bins(F.col("text")))


def with_next(docs: DataFrame, add: list[str], prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``docs`` with the columns ``add`` of the next row in descending doc_id order, as next_<name>.

    ``prepare`` may add columns to rows before they are ordered; it sees every row once. The row after the last is the first. Rows are dealt into ranges of ids with about as
    many rows each; every range also gets the first row of the range after it. The cut
    points and these rows are as many as the ranges, a fixed multiple of the partitions.
    """
    n = 4 * partitions(docs.sparkSession)
    cuts = sorted(set(docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n))))
    place = F.when(F.col("doc_id").isNull(), -1).otherwise(
        F.size(F.filter(constants(cuts), lambda c: c <= F.col("doc_id"))))
    rows = docs.withColumn("_range", place).withColumn("_extra", F.lit(False))
    # The largest id of each range opens it; the range above ends with that row, the lowest with the very first.
    up = Window.orderBy("_range")
    opens = (
        docs.select("doc_id", place.alias("_range")).groupBy("_range").agg(F.max("doc_id").alias("_open"))
        .withColumn("_above", F.coalesce(F.lead("_range").over(up), F.first("_range").over(up)))
        .withColumnRenamed("_range", "_at")
    )
    opens = F.broadcast(opens)  # a row per range
    extra = (
        rows.join(opens, (rows["_range"] == opens["_at"]) & rows["doc_id"].eqNullSafe(opens["_open"]))
        .withColumn("_range", F.col("_above")).withColumn("_extra", F.lit(True)).select(*rows.columns)
    )
    order = Window.partitionBy("_range").orderBy("_extra", F.col("doc_id").desc_nulls_last(), "text")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in add]
    return prepare(rows.unionByName(extra)).select("*", *following).filter(~F.col("_extra")).drop("_range", "_extra")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: fingerprints of its text and of the text whose second half is the start of the next
    document, and the likeness of its fingerprint to that and to the next document's."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(texts, ["text", "bins"], lambda rows: rows.withColumn("bins", packed_bins(F.col("text"))))
    n = F.length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    text, following = F.col("text"), F.col("next_text")
    rows = (
        rows.withColumn("n_chars", n)
        .withColumn("edited", F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(following, F.lit(1), half)))
        .withColumn("edited_bins", packed_bins(F.col("edited")))
    )
    return rows.select(
        "doc_id", "n_chars", "edited", "bins", "edited_bins", as_text(F.col("bins")).alias("fingerprint"),
        as_text(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"))
