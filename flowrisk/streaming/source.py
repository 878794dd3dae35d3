"""File streams of flows and the sinks that end them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowrisk.session import shared_path


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet",
                files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Files of a folder as a stream, at most ``files_per_batch`` of them per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def dataset_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """A dataset as a stream, be it one file or a folder of part files at any depth."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    if found.isEmpty():
        raise FileNotFoundError(f"no file under {path}")
    reader = spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A lone file is a folder's only match; a folder is read with all its part files.
    lone = found.limit(2).collect()
    if len(lone) == 1 and lone[0]["path"].rstrip("/").endswith("/" + path.rstrip("/").rsplit("/", 1)[-1]):
        parent, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).load(parent)
    return reader.load(path)


ROW_GROUP = 4 << 20  # bytes


def replayed(df: DataFrame, ts: str, parts: int = 5, files: int = 1) -> tuple[str, DataFrame]:
    """``df`` written in event order as ``parts`` micro-batches of ``files`` files each.

    Returns the folder and the stream over it. Cut points are quantiles of ``ts``; rows of
    one time are never parted, so arrival follows event time. Files consist of small row
    groups, so that a micro-batch is read by many tasks, even if it is one file.
    """
    spark, path = df.sparkSession, shared_path(df.sparkSession, "replay")
    at = F.col(ts).cast("timestamp").cast("double")
    cuts = sorted(set(df.select(at.alias("at")).approxQuantile("at", [i / parts for i in range(1, parts)], 0.001))) if parts > 1 else []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = df if low is None else df.filter(at > low)
        part = part if high is None else part.filter(at <= high)
        part.repartition(files).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)
    return path, file_stream(spark, path, df.schema, files_per_batch=files)


_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; the setting is put back afterwards."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Start writing an append stream to parquet, taking what is there and then stopping."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )


def each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str = "append"):
    return (
        stream.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run an available-now stream to its end and return what it wrote.

    ``complete`` keeps the last result table only.
    """
    spark = stream.sparkSession
    out, checkpoint = shared_path(spark, "stream"), shared_path(spark, "checkpoint")
    if mode == "append":
        append_to(stream, out, checkpoint).awaitTermination()
    else:
        def replace(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        each_batch(stream, replace, checkpoint, mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
