"""The interactive analyses as table operators: windows, week classes, trends, year over year, rankings and facets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import ratio
from bloomline.operators.mix import top_k, top_k_per
from bloomline.operators.profile import CLIENT
from bloomline.operators.structures import lately, since


def week_bands(df: DataFrame) -> DataFrame:
    """Stems per client and week with the client's exact quartiles and median over its weeks."""
    weeks = df.groupBy(*CLIENT, "year_week").agg(F.sum("stems").alias("stems"))
    q = weeks.groupBy(*CLIENT).agg(
        *[F.percentile("stems", F.lit(p)).alias(n) for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))], F.count(F.lit(1)).alias("weeks")
    )
    return weeks.join(q, CLIENT)


def regular_weeks(df: DataFrame) -> DataFrame:
    """Weeks near the client's middle; all of them where fewer than four are known or too few would stay."""
    iqr = F.col("q75") - F.col("q25")
    low, high = F.greatest(F.col("q25") - 1.5 * iqr, F.col("median") * 0.45), F.least(F.col("q75") + 1.5 * iqr, F.col("median") * 1.75)
    marked = week_bands(df).withColumn("inside", F.col("stems").between(low, high).cast("int"))
    inside = F.sum("inside").over(Window.partitionBy(*CLIENT))
    least = F.greatest(F.lit(2), F.least(F.lit(4), F.floor(F.col("weeks") / 2)))
    all_of_them = (F.col("weeks") < 4) | (F.col("median") <= 0) | (F.col("kept") < least)
    return marked.withColumn("kept", inside).where(all_of_them | (F.col("inside") == 1)).select(*CLIENT, "year_week", "stems")


def week_classification(df: DataFrame) -> DataFrame:
    s, m = F.col("stems"), F.col("median")
    near = F.coalesce(F.try_divide(F.abs(s - m), m) <= 0.25, F.lit(True))
    kind = (
        F.when(s >= F.greatest(F.col("q75") * 1.35, m * 1.5), "PICO").when(s <= F.col("q25") * 0.65, "ATIPICA_BAJA").when(near, "NORMAL").otherwise("VARIABLE")
    )
    return week_bands(df).select(*CLIENT, "year_week", "stems", kind.alias("week_class"))


def client_trend(df: DataFrame) -> DataFrame:
    """Weekly mean of the last 4 against the last 12 weeks, and what to buy by the share of solids and mixes."""
    flagged = since(df, {"in12": 12, "in4": 4})
    mean = lambda c: F.sum(F.when(F.col(c), F.col("stems")).otherwise(0.0)) / F.greatest(F.count_distinct(F.when(F.col(c), F.col("year_week"))), F.lit(1))
    share = lambda kinds: ratio(F.sum(F.when(F.col("order_type").isin(kinds), F.col("stems")).otherwise(0.0)), F.sum("stems"))
    per = flagged.groupBy(*CLIENT).agg(
        mean("in12").alias("mean_12w"), mean("in4").alias("mean_4w"), share(["SOLIDO"]).alias("solid_share"),
        share(["SURTIDO", "SURTIDO_M", "RAINBOW", "BOUQUET", "BQT", "COMBO"]).alias("mixed_share"),
    )
    return per.withColumns(
        {
            "trend": F.when(F.col("mean_4w") > F.col("mean_12w") * 1.15, "SUBE").when(F.col("mean_4w") < F.col("mean_12w") * 0.85, "BAJA").otherwise("ESTABLE"),
            "advice": F.when(F.col("solid_share") >= 0.55, "SOLIDOS_RECURRENTES").when(F.col("mixed_share") >= 0.45, "MEZCLA_COLOR_COMPOSICION").otherwise("COLOR_BASE_O_MANUAL"),
        }
    )


def window_comparison(df: DataFrame) -> DataFrame:
    """Weekly mean and dominant colour of all history, the last 12 and the last 4 weeks, and the change."""
    flagged = since(df, {"in12": 12, "in4": 4}).withColumn("always", F.lit(True))
    colors = flagged.groupBy(*CLIENT, "color").agg(*[F.sum(F.when(F.col(c), F.col("stems")).otherwise(0.0)).alias(f"s_{c}") for c in ("always", "in12", "in4")])
    top = colors.groupBy(*CLIENT).agg(*[F.max_by("color", F.struct(F.col(f"s_{c}"), F.col("color"))).alias(f"color_{c}") for c in ("always", "in12", "in4")])
    mean = lambda c: ratio(F.sum(F.when(F.col(c), F.col("stems")).otherwise(0.0)), F.count_distinct(F.when(F.col(c), F.col("year_week"))))
    means = flagged.groupBy(*CLIENT).agg(*[mean(c).alias(f"mean_{c}") for c in ("always", "in12", "in4")])
    return means.join(top, CLIENT).withColumn("change", F.try_divide(F.col("mean_in4") - F.col("mean_in12"), F.col("mean_in12")))


def ranked_dimension(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k largest values by weekly mean over regular weeks, with their share."""
    kept = df.join(regular_weeks(df).select(*CLIENT, "year_week"), [*CLIENT, "year_week"], "left_semi")
    weeks = kept.agg(F.count_distinct("year_week").alias("weeks"), F.sum("stems").alias("total"))
    per = kept.groupBy(column).agg(F.sum("stems").alias("stems")).join(F.broadcast(weeks))  # one row
    rated = per.select(column, "stems", (F.col("stems") / F.col("weeks")).alias("week_mean"), ratio(F.col("stems"), F.col("total")).alias("share"))
    return top_k(rated, k, "week_mean", column)


def yoy_change_chain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each year against the one before."""
    years = df.groupBy(*keys, "iso_year").agg(F.sum("stems").alias("stems"), F.sum("sales_usd").alias("sales_usd"))
    w = Window.partitionBy(*keys).orderBy("iso_year")
    before = F.lag("stems").over(w)
    return years.withColumns({"stems_before": before, "change": F.try_divide(F.col("stems") - before, before)})


def year_over_year(df: DataFrame, base: int, other: int) -> DataFrame:
    """Two years side by side per product, with deltas and the share in the second."""
    of = lambda y, c: F.sum(F.when(F.col("iso_year") == y, F.col(c)).otherwise(0.0))
    per = df.where(F.col("iso_year").isin(base, other)).groupBy("product").agg(
        of(base, "stems_confirmed").alias("stems_base"), of(other, "stems_confirmed").alias("stems_other"),
        of(base, "sales_usd").alias("usd_base"), of(other, "sales_usd").alias("usd_other"),
    )
    stems, usd = F.col("stems_other") - F.col("stems_base"), F.col("usd_other") - F.col("usd_base")
    whole = F.sum("stems_other").over(Window.partitionBy())  # one row per product
    return per.withColumns(
        {
            "delta_stems": stems, "delta_stems_pct": F.try_divide(stems, F.col("stems_base")), "delta_usd": usd,
            "delta_usd_pct": F.try_divide(usd, F.col("usd_base")), "share": F.try_divide(F.col("stems_other"), whole),
        }
    )


def mix_top(df: DataFrame, column: str, k: int = 7) -> DataFrame:
    """The k largest values and everything else as "Otros"."""
    per = df.groupBy(column).agg(F.sum("stems_confirmed").alias("stems"), F.sum("sales_usd").alias("sales_usd"))
    top = top_k(per, k, "stems", column).select(column, F.lit(True).alias("top"))
    named = per.join(F.broadcast(top), column, "left")  # k rows
    label = F.when(F.col("top"), F.col(column)).otherwise("Otros")
    return named.groupBy(label.alias(column)).agg(F.sum("stems").alias("stems"), F.sum("sales_usd").alias("sales_usd"))


def sales_by_period(df: DataFrame, keys: list[str]) -> DataFrame:
    per = df.groupBy(*keys).agg(F.sum("stems_confirmed").alias("confirmed"), F.sum("sales_usd").alias("sales_usd"), F.count_distinct("order_id").alias("orders"))
    return per.withColumn("price_usd", ratio(F.col("sales_usd"), F.col("confirmed")))


def facet_values(df: DataFrame, column: str, chosen: dict[str, list[str]]) -> DataFrame:
    """Values of a column by volume, under what was chosen in others."""
    for c, values in chosen.items():
        df = df.where(F.col(c).isin(values))
    return df.groupBy(F.col(column).alias("value")).agg(F.sum("stems").alias("stems"), F.count(F.lit(1)).alias("lines"))


def sku_ranking(df: DataFrame, k: int = 20) -> DataFrame:
    per = df.groupBy("sku_operational", "order_type").agg(
        F.sum("stems").alias("stems"), F.count_distinct("client_code").alias("clients"), F.count_distinct("year_week").alias("weeks"), F.sum("sales_usd").alias("sales_usd")
    )
    whole = df.agg(F.sum("stems").alias("total"))
    rated = per.join(F.broadcast(whole)).withColumn("share", ratio(F.col("stems"), F.col("total"))).drop("total")  # one row
    return top_k(rated, k, "stems", "sku_operational", "order_type")


def recent_sku_history(df: DataFrame) -> DataFrame:
    """Per client and SKU: the current week and the three before, the mean of 12 weeks, and the variation."""
    # Twelve weeks before the last date hold all twelve calendar weeks.
    recent = lately(df, 12)
    last = recent.agg(F.max("week_start").alias("last_week")).first().last_week
    dated = recent.withColumn("ago", (F.datediff(F.lit(last).cast("date"), "week_start") / 7).cast("int"))
    at = lambda k: F.sum(F.when(F.col("ago") == k, F.col("stems")).otherwise(0.0))
    recent = dated.where("ago < 12").groupBy(*CLIENT, "sku_operational").agg(
        *[at(k).alias(f"week_{k}") for k in range(4)], (F.sum("stems") / 12).alias("mean_12w")
    )
    return recent.withColumn("variation", F.try_divide(F.col("week_0") - F.col("mean_12w"), F.col("mean_12w")))


def color_composition(df: DataFrame, keys: list[str]) -> DataFrame:
    per = df.groupBy(*keys, "color").agg(F.sum("stems").alias("stems"))
    return per.withColumn("share", ratio(F.col("stems"), F.sum("stems").over(Window.partitionBy(*keys))))


def regular_order(df: DataFrame, k: int = 3) -> DataFrame:
    """A client's k most repeated structures."""
    per = df.groupBy(*CLIENT, "sku_operational").agg(F.count_distinct("order_date", "order_id").alias("times"), F.sum("stems").alias("stems"))
    return top_k_per(per, CLIENT, k, "times", "sku_operational")


def price_summary(df: DataFrame) -> DataFrame:
    """Prices per ordered stem and the commonest currency."""
    per = df.groupBy(*CLIENT).agg(
        F.sum("stems").alias("stems"), F.sum("sales_usd").alias("sales_usd"), F.sum("total_value").alias("total_value"), F.mode("currency", True).alias("currency")
    )
    return per.withColumns({"price_usd": ratio(F.col("sales_usd"), F.col("stems")), "price_original": ratio(F.col("total_value"), F.col("stems"))})
