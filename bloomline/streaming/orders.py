"""Order files and events as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomline.operators.cleaning import classify_order_type, keep_physical_or_value, operational_keys, typed_orders
from bloomline.sources.tables import scratch


def clean_orders_stream(raw: DataFrame) -> DataFrame:
    """The cleaning steps that need no grouping, over a stream of raw lines whose FECHA is a date already."""
    return keep_physical_or_value(operational_keys(classify_order_type(typed_orders(raw))))


def weekly_demand_stream(events: DataFrame, late: str = "14 days") -> DataFrame:
    """Demand per ISO week (windows start on Mondays), client and product; late says how long a week stays open."""
    weeks = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    per = weeks.groupBy(F.window("ts", "7 days", "7 days", "4 days").alias("w"), "user_id", "event_type").agg(
        F.sum("value").alias("stems"), F.count(F.lit(1)).alias("lines")
    )
    return per.select(F.col("w.start").cast("date").alias("week_start"), "user_id", "event_type", "stems", "lines")


def run_to_table(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there now and returns what it wrote."""
    spark = stream.sparkSession
    path = scratch(spark, "stream")

    def put(batch: DataFrame, epoch: int) -> None:
        # Complete mode replaces the table; in append mode a repeated epoch replaces itself.
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/epoch={epoch}")

    run = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", scratch(spark, "stream-state")).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
