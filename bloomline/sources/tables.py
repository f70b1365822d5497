"""Reading order files and yearly runs, writing result tables."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, under spark.checkpoint.dir; a temporary one only where a local session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='bloomline-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/bloomline/{name}-{uuid.uuid4().hex}"


#: Frames that are plain scans of stored files.
_STORED: weakref.WeakSet[DataFrame] = weakref.WeakSet()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: work that several plans share is done once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _STORED.add(out)
    return out


def stored_once(df: DataFrame, columns: set[str] | list[str], name: str) -> DataFrame:
    """These columns of df, stored; a frame that is stored already isn't written again, so that operators share one copy."""
    narrow = df.select(*sorted(set(columns)))
    if df not in _STORED:
        return stored(narrow, name)
    _STORED.add(narrow)
    return narrow


def read_orders_csv(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All columns as text (no inference pass); a byte order mark before the first name is dropped."""
    df = spark.read.csv(path, header=True, sep=sep, encoding=encoding, inferSchema=False, multiLine=False, escape='"')
    return df.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in df.columns})


SEPARATORS = ",;\t|"


def file_kinds(spark: SparkSession, path: str) -> DataFrame:
    """Per file its encoding (UTF-8, unless a line anywhere in it isn't) and its separator: the one that is in its first line most often, of
    equal ones the first of SEPARATORS. One scan of the raw lines; nothing is decoded on the driver."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")
    )
    per = lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("valid"), F.min(F.struct("start", "n", "value")).alias("first"))
    header = F.col("first.value")
    counts = [F.struct((F.length(F.replace(header, F.lit(c))) - F.length(header)).alias("n"), F.lit(k).alias("k"), F.lit(c).alias("sep")) for k, c in enumerate(SEPARATORS)]
    return per.select("file", F.when(F.col("valid"), "UTF-8").otherwise("ISO-8859-1").alias("encoding"), F.array_min(F.array(*counts)).sep.alias("sep"))


def read_orders_files(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text of files of different encodings and separators: one scan for each of both, columns matched by name, those that a
    file lacks as null."""
    groups: dict[tuple[str, str], list[str]] = {}
    for r in file_kinds(spark, path).collect():  # a short row for each file
        groups.setdefault((r.encoding, r.sep), []).append(r.file)
    if not groups:
        raise ValueError(f"no lines in {path}")
    parts = [read_orders_csv(spark, sorted(files), sep, encoding) for (encoding, sep), files in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only these columns of a Parquet table, those that it lacks as null: the scan reads no others."""
    df = spark.read.parquet(path)
    have = {c.lower() for c in df.columns}
    return df.select(*[F.col(c) if c.lower() in have else F.lit(None).cast("string").alias(c) for c in columns])


def read_yearly_runs(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Runs written by year=...; the latest without a year. The filter prunes partitions."""
    df = spark.read.parquet(path)
    year = year if year is not None else df.agg(F.max("year").alias("year")).first().year
    return df.where(F.col("year") == year)


def write_tables(tables: dict[str, DataFrame], path: str, kind: str = "parquet", columns: dict[str, list[str]] | None = None, skip: tuple[str, ...] = (), by: dict[str, str] | None = None) -> None:
    """One folder per table: some columns only, some tables left out, some partitioned by a column."""
    for name, df in tables.items():
        if name in skip:
            continue
        out = df.select(*columns[name]) if columns and name in columns else df
        writer = out.write.mode("overwrite")
        if by and name in by:
            writer = writer.partitionBy(by[name])
        if kind == "csv":
            writer.option("header", True).option("escape", '"').csv(f"{path}/{name}")
        else:
            writer.parquet(f"{path}/{name}")
