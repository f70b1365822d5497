"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that Spark hands to a Python task at a time: texts and pages may be long, and memory is the executor's.
BATCH_ROWS = 1_000


def bound_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where a local session names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
        if not found and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = found or f"file://{tempfile.mkdtemp(prefix='bloomline-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/bloomline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes df as Parquet in the shared folder and reads it back."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names) -> DataFrame:
    """df without the columns that an operator is about to add under these names (compared without case)."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
