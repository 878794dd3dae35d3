"""A training corpus from raw documents: filter, deduplicate, redact, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, the table the
stage before it wrote; all but the last return the columns of documents. Further columns
of documents are dropped. Nulls, empty texts, repeated rows and empty tables give the
results that the operators define; a stage never fails on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowrisk.llm import mixing, near_text, packing, queries, secrets, toxicity
from flowrisk.llm.common import table
from flowrisk.session import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose restored text is not toxic; null texts stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs.select(*COLUMNS), model).filter(F.col("score") < toxicity.TOXIC_FROM).select(*COLUMNS)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id.

    Of rows with equal ids one stays. Rows without an id stay unless their text is that of
    a document with one.
    """
    found = near_text.near_duplicates(docs)
    out = found.filter(~F.coalesce("kept", F.lit(False)) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    named = docs.filter(F.col("doc_id").isNotNull()).select(*COLUMNS).join(out, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    nameless = docs.filter(F.col("doc_id").isNull()).select(*COLUMNS)
    again = docs.filter(F.col("doc_id").isNotNull()).select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("_sha")).distinct()
    nameless = nameless.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")), 256)).join(again, "_sha", "left_anti").drop("_sha")
    return named.select(*COLUMNS).unionByName(nameless)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and n_chars counted anew where there were any."""
    model = secrets.fit(secrets.labelled_samples(docs))
    found = secrets.all_spans(F.coalesce("text", F.lit("")), model)
    rows = docs.select(*COLUMNS).withColumn("_found", found)
    some, clear = F.size("_found") > 0, F.col("text")
    return (
        rows.withColumn("text", F.when(some, secrets.redacted(clear, F.col("_found"))).otherwise(clear))
        .withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*COLUMNS)
    )


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, a row for each copy. Rows with equal ids are mixed together."""
    mixed = mixing.mix_sources(mixing.document_sizes(docs))
    # Rows with equal ids have their copies counted together and take the same number each.
    copies = mixed.groupBy("doc_id").agg(F.ceil(F.avg("copies")).cast("int").alias("_copies"))
    rows = docs.select(*COLUMNS).join(copies.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
    return rows.filter("_copies > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents, each with its sequence and its place there."""
    capacity = packing.Capacity()
    return packing.pack(packing.tokenized_pieces(docs, queries.tokenizer_path(), capacity.tokens), capacity)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicate_filter),
    ("secrets", secret_redaction),
    ("source_mixing", source_mix),
    ("packing", sequence_packing),
]

# Learned scores and random draws have no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
CHECKS: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
