"""Exact duplicate removal by content sort (DataFrame functions only).

Rows are range-partitioned by sampled splitters over the leading bytes of the text, its hash and a salt, sorted
externally inside each partition, and runs of equal neighbours are found by comparing whole texts. Splitters stay a few
dozen bytes each, whatever the length of the texts.

A text that very many rows share would fill one partition. A first pass counts digests (combined map-side); the texts
with more than ``max(MIN_HOT_ROWS, rows / HOT_SHARE)`` rows are at most HOT_SHARE many, so their list has a proven size
bound and is broadcast. Their rows are salted in the sort, and their survivor and size come from the pre-aggregation.

Defined results: null text counts as empty; of rows with equal text and equal id exactly one is kept; a row whose id is
null survives only if all ids of its group are null; an empty table gives an empty result; columns of the input named
like an output column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bloomline.llm.common import shuffle_partitions, without

OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")
MIN_HOT_ROWS = 256
HOT_SHARE = 10_000
PREFIX = 24


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """All rows and columns of docs with keep_id, group_size, kept and text_sha256; keep: "max" or "min" id stays."""
    if keep not in ("max", "min"):
        raise ValueError("keep must be max or min")
    spark = docs.sparkSession
    n_rows = docs.count()
    parts = shuffle_partitions(spark)
    hot_rows = max(MIN_HOT_ROWS, n_rows // HOT_SHARE)
    salted_rows = max(MIN_HOT_ROWS, n_rows // (8 * parts))
    best = F.max if keep == "max" else F.min

    base = without(docs, OUTPUTS)
    row = base.select(
        F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body"),
    ).withColumn("sha", F.sha2("body", 256))
    hot = (
        row.groupBy("sha")
        .agg(F.count(F.lit(1)).alias("hot_size"), best("id").alias("hot_keep"))
        .where(F.col("hot_size") > hot_rows)
    )
    slots = F.ceil(F.col("hot_size") / F.lit(salted_rows))
    salted = row.join(F.broadcast(hot), "sha", "left").withColumn(
        "salt", F.when(slots.isNotNull(), F.pmod(F.xxhash64("id"), slots)).otherwise(F.lit(0).cast("bigint"))
    )
    keys = ["lead", "hash", "salt"]
    dealt = (
        salted.withColumn("lead", F.substring("body", 1, PREFIX))
        .withColumn("hash", F.xxhash64("body"))
        .repartitionByRange(parts, *keys)
    )
    # A range partitioning by these keys already brings the rows of each run together: no further exchange.
    by_id = F.desc_nulls_last("id") if keep == "max" else F.asc_nulls_last("id")
    run = Window.partitionBy(*keys, "body").orderBy(by_id)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = dealt.select(
        "row", "id", "sha", "hot_size", "hot_keep",
        F.row_number().over(run).alias("place"),
        F.first("id").over(whole).alias("run_keep"),
        F.count(F.lit(1)).over(whole).alias("run_size"),
    )
    is_hot = F.col("hot_size").isNotNull()
    keep_id = F.when(is_hot, F.col("hot_keep")).otherwise(F.col("run_keep"))
    return marked.select(
        "row.*",
        keep_id.alias("keep_id"),
        F.when(is_hot, F.col("hot_size")).otherwise(F.col("run_size")).alias("group_size"),
        # Only the slot of the surviving id holds it, and there it comes first.
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
