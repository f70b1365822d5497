"""Repeated structures, typical weeks, SKU summaries, compositions and their signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import ratio
from bloomline.operators.cleaning import MIXED
from bloomline.operators.mix import bounded
from bloomline.operators.profile import CLIENT
from bloomline.sources.tables import stored_once

STRUCTURE = ["actionable_key", "order_type", "product", "variety", "color", "box_type", "stems_per_bunch", "sleeve", "food", "packaging"]
TYPICAL = ["iso_week", "product", "order_type", "color", "variety", "box_type", "stems_per_bunch"]


def since(df: DataFrame, weeks: dict[str, int]) -> DataFrame:
    """df with a flag per name: within so many weeks (inclusive) of the last date of all."""
    last = df.agg(F.max("order_date").alias("last_of_all"))
    out = df.join(F.broadcast(last))  # one row
    return out.withColumns({n: F.col("order_date") >= F.date_sub("last_of_all", 7 * w) for n, w in weeks.items()}).drop("last_of_all")


def lately(df: DataFrame, weeks: int) -> DataFrame:
    """The lines of the last weeks (inclusive) before the last date of all. The date is looked up first: as a fixed value it reaches the scans
    and what lies between, and no older line is cleaned or moved."""
    last = df.agg(F.max("order_date").alias("last")).first().last
    return df.where(F.col("order_date") >= F.date_sub(F.lit(last).cast("date"), 7 * weeks))


def actionable_key() -> Column:
    kind = F.col("order_type")
    return (
        F.when(kind == "SOLIDO", F.col("sku_finished"))
        .when(kind.isin(MIXED), F.col("recipe_program_key"))
        .when(kind == "BULK", F.col("product_color"))
        .otherwise(F.col("analysis_key"))
    )


def repeated_structures(df: DataFrame) -> DataFrame:
    """Per client and structure: history, the last 12 and 4 weeks, validity and what to do."""
    flagged = since(df, {"in12": 12, "in4": 4}).withColumn("actionable_key", actionable_key())
    per = flagged.groupBy(*CLIENT, *STRUCTURE).agg(
        F.sum("stems").alias("stems"),
        F.count_distinct("year_week").alias("weeks"),
        F.count_distinct("order_id").alias("orders"),
        bounded(ratio(F.sum("stems_confirmed"), F.sum("stems"))).alias("fulfilment"),
        F.sum(F.when(F.col("in12"), F.col("stems")).otherwise(0.0)).alias("stems_12w"),
        F.count_distinct(F.when(F.col("in12"), F.col("year_week"))).alias("weeks_12w"),
        F.sum(F.when(F.col("in4"), F.col("stems")).otherwise(0.0)).alias("stems_4w"),
        F.count_distinct(F.when(F.col("in4"), F.col("year_week"))).alias("weeks_4w"),
    )
    kind, recent = F.col("order_type"), F.col("weeks_12w")
    return per.withColumns(
        {
            "validity": F.when((F.col("weeks_4w") > 0) & (recent >= 2), "VIGENTE")
            .when((recent > 0) & (F.col("weeks") <= recent + 1), "NUEVA_RECIENTE")
            .when(recent > 0, "ACTIVA_RECIENTE").otherwise("HISTORICA_NO_RECIENTE"),
            "advice": F.when((kind == "SOLIDO") & (recent >= 3) & (F.col("fulfilment") < 0.98), "COMPRAR_TERMINADO")
            .when((kind == "SOLIDO") & (recent >= 2), "PILOTO")
            .when(kind.isin("SURTIDO", "SURTIDO_M") & (recent >= 2), "COMPRAR_COLOR_BASE")
            .when(kind.isin("RAINBOW", "COMBO", "BOUQUET", "BQT") & (recent >= 2), "REVISAR_MANUAL")
            .when((kind == "BULK") & (recent >= 2), "COMPRAR_COLOR_BASE")
            .when(recent == 0, "NO_ANTICIPAR").otherwise("REVISAR_MANUAL"),
        }
    )


def typical_week(df: DataFrame) -> DataFrame:
    """One ISO week across years: level, spread, recent behaviour, confidence and class."""
    flagged = since(df, {"in12": 12})
    per = flagged.groupBy(*CLIENT, *TYPICAL, "iso_year").agg(F.sum("stems").alias("s"), F.sum(F.when(F.col("in12"), F.col("stems")).otherwise(0.0)).alias("r"))
    weeks = per.groupBy(*CLIENT, *TYPICAL).agg(
        F.percentile("s", F.lit(0.5)).alias("median_stems"),
        F.avg("s").alias("mean_stems"),
        F.count(F.lit(1)).alias("years_seen"),
        F.try_divide(F.stddev_samp("s"), F.avg("s")).alias("cv"),
        F.sum("r").alias("recent_stems"),
    )
    seen, cv = F.col("years_seen"), F.col("cv")
    return weeks.withColumns(
        {
            "confidence": F.when((seen >= 3) & (cv <= 0.45), "ALTA").when((seen >= 2) & (cv <= 0.8), "MEDIA").otherwise("BAJA"),
            "week_class": F.when(seen == 1, "SEMANA_SIN_PATRON").when(cv <= 0.45, "SEMANA_ESTABLE").when(cv > 1.2, "SEMANA_PICO").otherwise("SEMANA_VARIABLE"),
        }
    )


def sku_composition(df: DataFrame) -> DataFrame:
    """Components of each operational SKU: share and stability of the weekly colour share."""
    sku = [*CLIENT, "sku_operational"]
    item = ["product", "variety", "color", "grade"]
    per = df.groupBy(*sku, *item).agg(F.sum("stems").alias("stems"), F.count_distinct("year_week").alias("weeks"))
    shared = per.withColumn("share", ratio(F.col("stems"), F.sum("stems").over(Window.partitionBy(*sku))))
    weekly = df.groupBy(*sku, "year_week", "color").agg(F.sum("stems").alias("s"))
    parts = weekly.withColumn("p", ratio(F.col("s"), F.sum("s").over(Window.partitionBy(*sku, "year_week"))))
    spread = parts.groupBy(*sku, "color").agg(F.coalesce(F.stddev_samp("p"), F.lit(0.0)).alias("share_std"))
    joined = shared.join(spread, [*sku, "color"], "left")
    stable = F.when(F.col("share_std") <= 0.08, "ESTABLE").when(F.col("share_std") <= 0.18, "MEDIA").otherwise("VARIABLE")
    return joined.withColumn("stability", stable)


ITEM = ["product", "variety", "color", "grade"]


def _parts(df: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Per key and item: stems, and the item with its share as text. The lines are moved once, by the keys alone: items, shares and what is
    made of them lie together then."""
    per = df.repartition(*keys).groupBy(*keys, *ITEM).agg(F.sum("stems").alias("s"), *more)
    share = F.bround(ratio(F.col("s"), F.sum("s").over(Window.partitionBy(*keys))), 3)
    return per.withColumn("part", F.concat_ws("|", *ITEM, F.format_string("%.3f", share)))


def _composition() -> Column:
    return F.array_join(F.sort_array(F.collect_list("part")), " / ")


def _signature(composition: Column) -> Column:
    return F.substring(F.sha1(F.encode(composition, "UTF-8")), 1, 12)


def composition_signature(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the sorted mix as text and the first 12 hex digits of its SHA-1: the same for any order of rows."""
    listed = _parts(df, keys).groupBy(*keys).agg(_composition().alias("composition"))
    return listed.withColumn("signature", _signature(F.col("composition")))


EVENT = [*CLIENT, "order_date", "year_week", "order_id", "box_key", "sku_operational"]
#: What events, their components and their boxes are made of.
EVENT_USED = {*EVENT, *ITEM, "stems", "program_bunches"}


def structure_components(df: DataFrame) -> DataFrame:
    """Components of each client, week, SKU and version (the composition of an event) with share and events."""
    listed = F.collect_list("part").over(Window.partitionBy(*EVENT))
    parts = _parts(df, EVENT).withColumn("signature", _signature(F.array_join(F.sort_array(listed), " / ")))
    keys = [*CLIENT, "year_week", "sku_operational", "signature"]
    # An event has one row of an item here, so that its rows are its events.
    known = F.when(F.col("order_date").isNotNull() & F.col("order_id").isNotNull() & F.col("box_key").isNotNull(), 1)
    per = parts.groupBy(*keys, *ITEM).agg(F.sum("s").alias("stems"), F.count(known).alias("events"))
    return per.withColumn("share", ratio(F.col("stems"), F.sum("stems").over(Window.partitionBy(*keys))))


def structure_boxes(df: DataFrame) -> DataFrame:
    """Per client, week, SKU and version: how often it was sent, with how many stems."""
    parts = _parts(df, EVENT, F.max("program_bunches").alias("b"))
    events = parts.groupBy(*EVENT).agg(_signature(_composition()).alias("signature"), F.sum("s").alias("stems"), F.max("b").alias("bunches"))
    return events.groupBy(*CLIENT, "year_week", "sku_operational", "signature").agg(
        F.count(F.lit(1)).alias("repetitions"), F.sum("stems").alias("stems"), F.sum("bunches").alias("bunches")
    )


def structure_version_catalog(df: DataFrame) -> DataFrame:
    events = _parts(df, EVENT).groupBy(*EVENT).agg(_signature(_composition()).alias("signature"), F.sum("s").alias("stems"))
    return events.groupBy(*CLIENT, "sku_operational", "signature").agg(
        F.count(F.lit(1)).alias("times"),
        F.count_distinct("year_week").alias("weeks"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.avg("stems").alias("mean_stems"),
    )


def stem_conservation(df: DataFrame) -> DataFrame:
    """Stems in history, boxes and components: equal if nothing was lost. The narrow lines are written once for the three."""
    df = stored_once(df, EVENT_USED, "audit-lines")
    total = lambda d, n: d.agg(F.sum("stems").alias("stems")).select(F.lit(n).alias("part"), "stems")
    return total(df, "history").unionByName(total(structure_boxes(df), "boxes")).unionByName(total(structure_components(df), "components"))
