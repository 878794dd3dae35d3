"""Session defaults for local runs, and the shared folder for intermediate tables."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and benchmarks on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("flowrisk")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    Every executor has to see it, so a machine-local folder is used only when the
    session itself is local and names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="flowrisk-")
    return f"{base.rstrip('/')}/flowrisk/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: fixed rows, no lineage, columnar re-reads."""
    spark = df.sparkSession
    path = shared_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
