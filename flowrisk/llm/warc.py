"""WARC archives: writing captures, reading records back, assembling transactions.

A capture is written as a request, a response or revisit, and a metadata record, tied
together by WARC-Concurrent-To. Archives are written by Spark's text writer: a row is a
record, the line separator the two line ends that close a record, gzip goes over whole
files. They are read as binary files and cut by Content-Length, so that a payload may
contain anything. Assembly joins the three records of a capture by their identifiers and
gives one nested row per capture.

Defined cases: null html is an empty payload; null urls and ids are written as empty
fields and read back as null; rows with equal page_id are separate captures, unless their
payloads are equal too: then they share identifiers and a type, and each is read back; an
empty table gives an empty archive and an empty result; further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowrisk.llm.common import with_table
from flowrisk.session import shared_path, written

# Payloads shorter than this are always stored, as a revisit record would save nothing.
LEAST_REVISIT = 1000
END = "\r\n"
RECORDS_PER_FILE = 6_000
STAMP = "2024-01-01T00:00:00Z"

RECORD = ("record_id string, type string, target_uri string, concurrent_to string, refers_to string, "
          "capture string, block_bytes bigint, payload_bytes bigint, payload_digest string, payload binary")


def _uuid(kind: str, key: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), key))
    part = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))


def captures(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): its payload, key, and the key of the response it repeats."""
    rows = (
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
        .withColumn("_sha", F.sha2(F.col("html").cast("binary"), 256))
        .withColumn("_bytes", F.octet_length("html").cast("long"))
        .withColumn("_key", F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "_sha"))
    )
    # The largest page_id of each payload that occurs again; partial sums keep hot payloads cheap.
    first = (
        pages.select("page_id", F.coalesce("html", F.lit("")).alias("html"))
        .filter(F.octet_length("html") >= least)
        .groupBy(F.sha2(F.col("html").cast("binary"), 256).alias("_sha"))
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1").drop("_copies")
    )
    target = F.concat_ws("|", F.coalesce(F.col("_first").cast("string"), F.lit("-")), "_sha")
    return (
        with_table(rows, first.withColumn("_again", F.lit(True)), ["_sha"], "left")
        .withColumn("_of", F.when(F.col("_again") & (target != F.col("_key")), target))
        .select("page_id", "url", "html", "_bytes", "_key", "_of")
    )


def _record(kind: str, fields: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit(f"WARC/1.1{END}WARC-Type: {kind}"), F.lit(f"WARC-Date: {STAMP}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]  # null fields are left out
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(END, *lines), F.lit(END * 2), block)


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT) -> None:
    """Write three records per page to ``path``, a folder that all executors share."""
    rows = captures(pages, least)
    # Line ends and blanks in a url would end its field.
    uri = F.when(F.col("url").isNotNull(), F.concat(F.lit("<"), F.url_encode("url"), F.lit(">")))
    key, of = F.col("_key"), F.col("_of")
    response_id = _uuid("response", key)
    type_line = F.lit("Content-Type: text/html; charset=utf-8" + END * 2)
    digest = F.concat(F.lit("sha1:"), F.sha1(F.col("html").cast("binary")))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Length: "), F.col("_bytes").cast("string"), F.lit(END), type_line)
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    common = [("WARC-Record-ID", response_id), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest)]
    request = _record("request", [
        ("WARC-Record-ID", _uuid("request", key)), ("WARC-Target-URI", uri), ("WARC-Concurrent-To", response_id),
        ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.lit(f"GET / HTTP/1.1{END}Accept: text/html{END * 2}"))
    response = _record("response", [*common, http], F.concat(head, F.col("html")))
    revisit = _record("revisit", [
        *common, ("WARC-Refers-To", _uuid("response", of)),
        ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), http], head)
    metadata = _record("metadata", [
        ("WARC-Record-ID", _uuid("metadata", key)), ("WARC-Target-URI", uri), ("WARC-Concurrent-To", response_id),
        ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(END)))
    records = F.array(request, F.when(of.isNull(), response).otherwise(revisit), metadata)
    (
        rows.select(F.explode(records).alias("value"))
        .write.option("lineSep", END * 2).option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


def parse_records(archive: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an uncompressed archive."""
    while line := archive.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = {}
        while (line := archive.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, archive.read(int(fields["content-length"]))


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"]
    payload = capture = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
    elif kind == "metadata":
        capture = block.decode("utf-8").partition("page_id:")[2].strip()
    return (
        fields["warc-record-id"], kind, fields.get("warc-target-uri"), fields.get("warc-concurrent-to"),
        fields.get("warc-refers-to"), capture, len(block), None if payload is None else len(payload),
        None if payload is None else hashlib.sha1(payload).hexdigest(), payload,
    )


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in ``path``; digests and lengths are of the payloads read."""
    names = [f.split()[0] for f in RECORD.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                with gzip.open(io.BytesIO(content)) as archive:
                    for fields, block in parse_records(archive):
                        row = _row(fields, block)
                        rows.append(row if with_payload else (*row[:-1], None))
                        held += len(block) if with_payload else 200
                        if held > 16_000_000:
                            yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})
                            rows, held = [], 0
                yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: page_id, target_uri and the nested request, response and metadata.

    A revisit carries no payload; length and digest are those of the response it refers
    to, whose identifiers stand in refers_to_id and refers_to (its page_id).
    """
    answers = records.filter(F.col("type").isin("response", "revisit"))
    short = ["record_id", "concurrent_to", "block_bytes"]
    # Captures that share identifiers share these records: one of each is enough.
    requests = records.filter("type = 'request'").select(
        F.col("concurrent_to").alias("_to"), F.struct(*short).alias("request")).dropDuplicates(["_to"])
    metadata = records.filter("type = 'metadata'").select(
        F.col("concurrent_to").alias("_to"), F.struct(*short, "capture").alias("metadata"),
        F.when(F.col("capture") != "", F.col("capture")).cast("long").alias("page_id")).dropDuplicates(["_to"])
    whole = (
        answers.join(requests, answers["record_id"] == requests["_to"], "left").drop("_to")
        .join(metadata, F.col("record_id") == metadata["_to"], "left").drop("_to")
    )
    # The responses that revisits refer to; hot ones are joined from the many side.
    stored = (
        records.filter("type = 'response'").select("record_id", F.col("payload_bytes").alias("_n"), F.col("payload_digest").alias("_digest"))
        .dropDuplicates(["record_id"]).join(metadata.select("_to", F.col("page_id").alias("_page")), F.col("record_id") == F.col("_to"))
        .select(F.col("record_id").alias("_stored"), "_n", "_digest", "_page")
    )
    # Written, as Spark splits a hot response's revisits only where both sides are plain tables.
    stored = written(stored, "warc-stored")
    uri = F.col("target_uri")
    return whole.join(stored, whole["refers_to"] == stored["_stored"], "left").select(
        "page_id", F.url_decode(uri.substr(F.lit(2), F.length(uri) - 2)).alias("target_uri"), "request",
        F.struct(
            "record_id", "type", F.col("refers_to").alias("refers_to_id"), F.col("_page").alias("refers_to"),
            F.coalesce("payload_bytes", "_n").alias("payload_bytes"),
            F.coalesce("payload_digest", "_digest").alias("payload_digest"), "payload",
        ).alias("response"), "metadata")


def round_trip(pages: DataFrame, path: str | None = None, least: int = LEAST_REVISIT,
               with_payload: bool = True) -> DataFrame:
    """Write ``pages`` to archives, read them back and assemble the captures."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path, least)
    records = read_records(spark, path, with_payload)
    return assemble(records if with_payload else written(records, "warc-records"))
