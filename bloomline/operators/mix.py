"""Mixes, series and sales: one grouped aggregate each, at many grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import ratio
from bloomline.operators.profile import CLIENT
from bloomline.sources.tables import stored_once

PACKED = ["order_type", "order_subtype", "pack_order_type", "pack_type"]
ITEM = ["product", "variety", "color", "grade", "box_type", "stems_per_bunch", "sleeve", "food", "packaging", "recipe"]
MIXES = {
    "mix_order_type": [*PACKED, "recipe"],
    "mix_color": ["color"],
    "mix_product": ["product"],
    "mix_variety": ["product", "variety", "color"],
    "mix_sku_finished": ["sku_finished", *PACKED, *ITEM],
    "mix_sku_flexible": ["sku_flexible", "order_type", "product", "color", "grade", "box_type", "stems_per_bunch"],
    "mix_packaging": ["pack_key", "order_type", "box_type", "stems_per_bunch", "sleeve", "food", "packaging"],
    "mix_analysis": ["family", "focus", "color_role", "analysis_key", "order_type", "product", "color", "box_type", "recipe"],
    "mix_color_role": ["family", "color_role", "order_type", "product", "color"],
}
PERIOD = ["iso_year", "iso_week", "year_week"]
SALES = {
    "sales_week_client_product": [*PERIOD, *CLIENT, "order_type", "product", "color", "currency"],
    "sales_product_period": [*PERIOD, "order_type", "product", "color", "currency"],
    "sales_client_period": [*PERIOD, *CLIENT, "currency"],
    "sales_box_period": [*PERIOD, *CLIENT, "order_type", "product", "color", "box_key", "box_type", "currency"],
    "price_client_product": [*CLIENT, "product", "color"],
    "price_client_week": [*PERIOD, *CLIENT],
    "price_product_currency": ["product", "currency"],
    "price_client_sku": [*CLIENT, "sku_finished"],
}


def bounded(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def mix(df: DataFrame, keys: list[str]) -> DataFrame:
    """Stems, weeks and dates of a client's values, their share of the client and fulfilment."""
    per = df.groupBy(*CLIENT, *keys).agg(
        F.sum("stems").alias("stems"),
        F.sum("stems_confirmed").alias("confirmed"),
        F.sum("shortfall").alias("shortfall"),
        F.count_distinct("year_week").alias("active_weeks"),
        F.count_distinct("order_date").alias("active_dates"),
    )
    total = F.sum("stems").over(Window.partitionBy(*CLIENT))
    return per.withColumns(
        {
            "client_stems": total,
            "client_share": ratio(F.col("stems"), total),
            "fulfilment": bounded(ratio(F.col("confirmed"), F.col("stems"))),
        }
    )


def series_client_week(df: DataFrame) -> DataFrame:
    return df.groupBy(*CLIENT, "year_week", "iso_year", "iso_week").agg(
        F.sum("stems").alias("stems"),
        F.sum("stems_confirmed").alias("confirmed"),
        F.sum("shortfall").alias("shortfall"),
        F.count_distinct("color").alias("colors"),
        F.count_distinct("sku_finished").alias("skus_finished"),
        F.count_distinct("product").alias("products"),
        F.count_distinct("order_type").alias("order_types"),
    )


def series_client_month_color(df: DataFrame) -> DataFrame:
    return df.groupBy(*CLIENT, "iso_year", "month", "color").agg(F.sum("stems").alias("stems"), F.sum("shortfall").alias("shortfall"))


def sales(df: DataFrame, keys: list[str]) -> DataFrame:
    """Stems, value, orders, boxes and volume-weighted prices per confirmed stem."""
    per = df.groupBy(*keys).agg(
        F.sum("stems_confirmed").alias("confirmed"),
        F.sum("sales_usd").alias("sales_usd"),
        F.sum("total_value").alias("total_value"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("box_key").alias("boxes"),
    )
    return per.withColumns(
        {"price_usd": ratio(F.col("sales_usd"), F.col("confirmed")), "price_original": ratio(F.col("total_value"), F.col("confirmed"))}
    )


DEMAND_KEYS = ["order_date", "year_week", *CLIENT, "order_type", "product", "variety", "color", "grade", "box_type", "analysis_key"]


def operational_demand_summary(df: DataFrame, source: str | Column) -> DataFrame:
    """source: a name for all lines, or a column that tells the lines of several apart."""
    named = df.withColumn("source", F.lit(source) if isinstance(source, str) else source)
    per = named.groupBy(*DEMAND_KEYS, "source").agg(F.sum("stems").alias("stems"), F.count_distinct("order_id").alias("orders"))
    return per.select(*DEMAND_KEYS, "stems", "orders", "source")


def operational_rollup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Any grain: stems, USD, orders, boxes, weeks, price and fulfilment."""
    per = df.groupBy(*keys).agg(
        F.sum("stems").alias("stems"),
        F.sum("stems_confirmed").alias("confirmed"),
        F.sum("sales_usd").alias("sales_usd"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("box_key").alias("boxes"),
        F.count_distinct("year_week").alias("weeks"),
    )
    return per.withColumns(
        {"price_usd": ratio(F.col("sales_usd"), F.col("stems")), "fulfilment": bounded(ratio(F.col("confirmed"), F.col("stems")))}
    )


def top_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(k)


def top_k_per(df: DataFrame, keys: list[str], k: int, by: str, *ties: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(by), *ties))
    return df.withColumn("place", place).where(F.col("place") <= k)


def top_labels(df: DataFrame, keys: list[str], column: str, n: int, name: str) -> DataFrame:
    """The n most frequent values of a column, comma-joined, missing ones left out; ties by value."""
    per = df.where(F.col(column) != "sin_info").groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    kept = top_k_per(per, keys, n, "n", column)
    return kept.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", column))), lambda s: s[column]), ", ").alias(name))


def distinct_labels(df: DataFrame, keys: list[str], column: str, n: int, name: str) -> DataFrame:
    per = df.where(F.col(column) != "sin_info").select(*keys, column).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(column))
    kept = per.withColumn("place", place).where(F.col("place") <= n)
    return kept.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(column)), ", ").alias(name))


def client_week_sku(df: DataFrame) -> DataFrame:
    """The narrow lines are written once: sums and both lists of labels are made of them."""
    keys = [*CLIENT, "iso_year", "iso_week", "sku_operational"]
    df = stored_once(df, [*keys, "year_week", "product", "color", "stems", "stems_confirmed", "sales_usd", "order_id", "box_key"], "week-sku-lines")
    per = operational_rollup(df, keys).drop("price_usd")
    labelled = per.join(top_labels(df, keys, "product", 3, "top_products"), keys, "left").join(top_labels(df, keys, "color", 3, "top_colors"), keys, "left")
    week = F.sum("stems").over(Window.partitionBy(*CLIENT, "iso_year", "iso_week"))
    return labelled.withColumn("week_share", ratio(F.col("stems"), week))
