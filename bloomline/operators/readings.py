"""Readings of a client's recent structures, windows and changes, and of forecasts: what reports show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import MISSING, ratio
from bloomline.operators.mix import bounded, top_k, top_k_per
from bloomline.operators.profile import CLIENT
from bloomline.operators.structures import lately, since
from bloomline.sources.tables import stored

# Attributes that tell why two clients are alike, windows of weeks and their weights, weeks of seasonal peaks.
REASONS = ["product", "color", "order_type", "stems_per_bunch", "sleeve", "packaging"]
NO_REASON = "similitud por vectores de producto/color/tipo de pedido"
PERIODS = {"4w": 4, "8w": 8, "12w": 12, "26w": 26, "52w": 52}
RECENCY_WEIGHTS = {4: 0.35, 8: 0.25, 12: 0.20, 52: 0.10, None: 0.10}
SEASON_PEAKS = [5, 6, 7, 8, 18, 19, 20, 21, 22, 44, 45, 46, 47, 48, 49, 50, 51]

FORMAT = ["order_type", "product", "variety", "box_type", "stems_per_bunch", "sleeve", "food", "packaging"]
COMPONENT = ["product", "color", "variety", "box_type", "stems_per_bunch", "sleeve", "food", "packaging"]


def structure_shown() -> Column:
    """The structure as a report names it."""
    kind = F.col("order_type")
    return F.when(kind == "SOLIDO", F.col("product_color")).when(kind == "BULK", F.concat_ws("|", "product", "color")).otherwise(F.col("sku_operational"))


def _recent(df: DataFrame, weeks: int) -> DataFrame:
    """The lines of the recent weeks with their structure, narrow and written once: totals, weeks and mixes are all made of them."""
    used = {"year_week", "stems", "stems_confirmed", "bunches_ordered", "color", *CLIENT, *FORMAT, *COMPONENT} & set(df.columns)
    return stored(lately(df, weeks).select(*sorted(used), structure_shown().alias("structure")), "recent-lines")


def recent_structures(df: DataFrame, weeks: int = 12, colors: int = 6) -> DataFrame:
    """Per client the structures of the recent weeks: weekly mean, share, fulfilment, colour mix as text, and advice.

    The lines are summed once by structure and colour; the mix and the totals both come from that."""
    recent = _recent(df, weeks)
    keys = [*CLIENT, "structure", *FORMAT]
    active = recent.groupBy(*CLIENT).agg(F.count_distinct("year_week").alias("client_weeks"))
    per_week = recent.groupBy(*keys, "color", "year_week").agg(F.sum("stems").alias("s"), F.sum("stems_confirmed").alias("c"))
    base = per_week.groupBy(*keys).agg(F.sum("s").alias("stems"), F.count_distinct("year_week").alias("weeks"), bounded(ratio(F.sum("c"), F.sum("s"))).alias("fulfilment"))
    mix = per_week.groupBy(*keys, "color").agg(F.sum("s").alias("s"))
    percent = F.bround(ratio(F.col("s"), F.sum("s").over(Window.partitionBy(*keys))) * 100, 0).cast("int")
    named = mix.withColumn("part", F.concat(F.col("color"), F.lit(" "), percent.cast("string"), F.lit("%")))
    top = top_k_per(named, keys, colors, "s", "color")
    text = top.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("s")).alias("n"), "color", "part"))).alias("parts"))
    joined = base.join(text, keys).join(active, CLIENT)
    mean = F.col("stems") / F.col("client_weeks")
    whole = F.sum("stems").over(Window.partitionBy(*CLIENT))
    kind, seen = F.col("order_type"), F.col("weeks")
    recipes = ["RAINBOW", "COMBO", "BOUQUET", "BQT"]
    return joined.withColumns(
        {
            "color_mix": F.array_join(F.transform("parts", lambda p: p["part"]), ", "), "week_mean": mean, "share": ratio(F.col("stems"), whole),
            "reading": F.when(kind == "SOLIDO", "SKU terminado exacto").when(kind.isin("SURTIDO", "SURTIDO_M"), "Mezcla de colores/composicion")
            .when(kind.isin(recipes), "Receta/composicion").when(kind == "BULK", "Producto-color volumen").otherwise("Revision manual"),
            "advice": F.when((kind == "SOLIDO") & (seen >= 2) & (F.col("fulfilment") >= 0.9), "COMPRAR_TERMINADO").when(kind == "SOLIDO", "PILOTO")
            .when(kind.isin("SURTIDO", "SURTIDO_M", "BULK") & (seen >= 2), "COMPRAR_COLOR_BASE").when(kind.isin(recipes) & (seen >= 2), "REVISAR_COMPOSICION").otherwise("NO_ANTICIPAR"),
        }
    ).drop("parts", "client_weeks")


def sku_components_window(df: DataFrame, weeks: int = 12) -> DataFrame:
    """Per client and structure of the recent weeks its components: weekly mean, share, and how steady the colour's share is."""
    recent = _recent(df, weeks)
    sku = [*CLIENT, "structure"]
    active = recent.groupBy(*sku).agg(F.count_distinct("year_week").alias("sku_weeks"))
    per = recent.groupBy(*sku, *COMPONENT).agg(F.sum("stems").alias("stems"), F.sum("bunches_ordered").alias("bunches"), F.count_distinct("year_week").alias("weeks"))
    weekly = recent.groupBy(*sku, "year_week", "color").agg(F.sum("stems").alias("s"))
    parts = weekly.withColumn("p", ratio(F.col("s"), F.sum("s").over(Window.partitionBy(*sku, "year_week"))))
    spread = parts.groupBy(*sku, "color").agg(F.coalesce(F.stddev_samp("p"), F.lit(0.0)).alias("share_std"))
    joined = per.join(active, sku).join(spread, [*sku, "color"])
    steady = F.when(F.col("share_std") <= 0.08, "ESTABLE").when(F.col("share_std") <= 0.18, "MEDIA").otherwise("VARIABLE")
    return joined.withColumns(
        {
            "week_mean": F.col("stems") / F.col("sku_weeks"), "bunches_week_mean": F.col("bunches") / F.col("sku_weeks"),
            "share": ratio(F.col("stems"), F.sum("stems").over(Window.partitionBy(*sku))), "stability": steady,
        }
    ).drop("sku_weeks")


def similarity_reasons(similar: DataFrame, df: DataFrame, most: int = 3) -> DataFrame:
    """similar (client_code, client, similar_code, similar_client) with reasons: which of the `most` largest values of each
    attribute both clients share, at most two of them named."""
    long = df.select(*CLIENT, F.col("stems").alias("w"), *[F.col(c).cast("string").alias(c) for c in REASONS]).unpivot([*CLIENT, "w"], REASONS, "attribute", "value")
    sums = long.groupBy(*CLIENT, "attribute", "value").agg(F.sum("w").alias("s"))
    top = top_k_per(sums, [*CLIENT, "attribute"], most, "s", "value")
    listed = top.groupBy(*CLIENT, "attribute").agg(F.sort_array(F.collect_list(F.struct((-F.col("s")).alias("n"), "value"))).alias("found"))
    tops = listed.select(*CLIENT, "attribute", F.transform("found", lambda x: x["value"]).alias("found"))
    others = tops.toDF("similar_code", "similar_client", "attribute", "other")
    pair = [*CLIENT, "similar_code", "similar_client"]
    met = similar.select(*pair).distinct().join(tops, CLIENT).join(others, ["similar_code", "similar_client", "attribute"])
    common = F.slice(F.filter("found", lambda x: (x != MISSING) & F.array_contains("other", x)), 1, 2)
    place = F.array_position(F.array(*[F.lit(c) for c in REASONS]), F.col("attribute"))
    said = met.withColumn("common", common).where("size(common) > 0")
    text = said.select(*pair, place.alias("place"), F.concat_ws(": ", "attribute", F.array_join("common", ", ")).alias("part"))
    joined = text.groupBy(*pair).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "part"))), lambda x: x["part"]), "; ").alias("reasons"))
    return similar.join(joined, pair, "left").withColumn("reasons", F.coalesce("reasons", F.lit(NO_REASON)))


def client_profile_windows(df: DataFrame) -> DataFrame:
    """Per client and period (the last 4 to 52 weeks, and all): volume, variety, fulfilment and the mean of active weeks."""
    flagged = since(df, PERIODS)
    periods = F.array_compact(F.array(*[F.when(F.col(p), p) for p in PERIODS], F.lit("all")))
    return flagged.withColumn("period", F.explode(periods)).groupBy(*CLIENT, "period").agg(
        F.sum("stems").alias("stems"), F.count_distinct("year_week").alias("weeks"), F.count_distinct("product").alias("products"),
        F.count_distinct("color").alias("colors"), F.count_distinct("sku_finished").alias("skus"),
        ratio(F.sum("stems_confirmed"), F.sum("stems")).alias("fulfilment"), (F.sum("stems") / F.count_distinct("year_week")).alias("week_mean"),
    )


def recency_weighted_mean(df: DataFrame) -> DataFrame:
    """Per client the mean of active weeks, weighted over the last 4, 8, 12 and 52 weeks and the whole history."""
    per = since(df, {f"in_{n}": n for n in RECENCY_WEIGHTS if n}).groupBy(*CLIENT, "year_week").agg(
        F.sum("stems").alias("s_all"), *[F.sum(F.when(F.col(f"in_{n}"), F.col("stems"))).alias(f"s_{n}") for n in RECENCY_WEIGHTS if n]
    )
    means = {n: F.coalesce(F.avg(f"s_{n or 'all'}"), F.lit(0.0)) for n in RECENCY_WEIGHTS}
    weighted = None
    for n, weight in RECENCY_WEIGHTS.items():
        weighted = means[n] * weight if weighted is None else weighted + means[n] * weight
    return per.groupBy(*CLIENT).agg(weighted.alias("weighted_mean"), means[None].alias("mean_all"))


def client_behavior_change(df: DataFrame, weeks: int = 12) -> DataFrame:
    """Per client the recent weeks against the whole history: volume, cosines of colours and products, and a class."""
    flagged = since(df, {"now": weeks, "lately": 2 * weeks})
    recent = F.when(F.col("now"), F.col("stems")).otherwise(0.0)
    base = flagged.groupBy(*CLIENT).agg(
        (F.sum("stems") / F.count_distinct("year_week")).alias("mean_all"), (F.sum(recent) / weeks).alias("mean_recent"),
        F.count_distinct(F.when(~F.col("now"), F.col("year_week"))).alias("weeks_before"),
        F.max(F.col("lately") & ~F.col("now")).alias("bought_before"), F.sum(recent).alias("stems_recent"),
    )
    long = flagged.select(*CLIENT, "stems", recent.alias("r"), "color", "product").unpivot([*CLIENT, "stems", "r"], ["color", "product"], "dim", "item")
    items = long.groupBy(*CLIENT, "dim", "item").agg(F.sum("stems").alias("a"), F.sum("r").alias("b"))
    of = lambda d, x: F.sum(F.when(F.col("dim") == d, x))
    a, b = F.col("a"), F.col("b")
    cosine = lambda d: F.coalesce(F.try_divide(of(d, a * b), F.sqrt(of(d, a * a)) * F.sqrt(of(d, b * b))), F.lit(0.0))
    alike = items.groupBy(*CLIENT).agg(cosine("color").alias("color_similarity"), cosine("product").alias("product_similarity"))
    change = F.try_divide(F.col("mean_recent"), F.col("mean_all"))
    least = F.least("color_similarity", "product_similarity")
    kind = (
        F.when(F.col("weeks_before") < 4, "CLIENTE_NUEVO_O_POCA_HISTORIA").when(F.col("stems_recent") == 0, "CLIENTE_EN_CAIDA")
        .when(~F.col("bought_before"), "CLIENTE_REACTIVADO").when(change > 1.3, "CLIENTE_EN_CRECIMIENTO").when(change < 0.7, "CLIENTE_EN_CAIDA")
        .when(least >= 0.85, "CLIENTE_ESTABLE_EN_EL_TIEMPO").when(least >= 0.6, "CLIENTE_CON_CAMBIO_RECIENTE_LEVE").otherwise("CLIENTE_CON_CAMBIO_RECIENTE_FUERTE")
    )
    return base.join(alike, CLIENT).withColumn("behavior", kind).drop("stems_recent")


def client_week_behavior(df: DataFrame) -> DataFrame:
    """Every client week: volume, variety, and whether it is far above or below the client's other weeks (quartiles and 1.5
    times their distance)."""
    weeks = df.groupBy(*CLIENT, "year_week").agg(
        F.sum("stems").alias("stems"), F.sum("stems_confirmed").alias("confirmed"), F.sum("shortfall").alias("shortfall"),
        F.count_distinct("product").alias("products"), F.count_distinct("color").alias("colors"), F.count_distinct("order_type").alias("types"),
    )
    usual = weeks.groupBy(*CLIENT).agg(F.percentile("stems", F.lit(0.25)).alias("low"), F.percentile("stems", F.lit(0.75)).alias("high"))
    reach = (F.col("high") - F.col("low")) * 1.5
    kind = F.when(F.col("stems") > F.col("high") + reach, "SEMANA_PICO").when(F.col("stems") < F.col("low") - reach, "SEMANA_ATIPICA_BAJA").otherwise("SEMANA_NORMAL")
    return weeks.join(usual, CLIENT).withColumn("week_class", kind).drop("low", "high")


def type_summaries(df: DataFrame) -> DataFrame:
    """Per client and order type: volume, share, structures, orders, weeks and fulfilment."""
    per = df.groupBy(*CLIENT, "order_type").agg(
        F.sum("stems").alias("stems"), F.count_distinct("sku_operational").alias("structures"), F.count_distinct("order_id").alias("orders"),
        F.count_distinct("year_week").alias("weeks"), ratio(F.sum("stems_confirmed"), F.sum("stems")).alias("fulfilment"),
    )
    return per.withColumn("share", ratio(F.col("stems"), F.sum("stems").over(Window.partitionBy(*CLIENT))))


def flexible_inventory_match(demand: DataFrame, inventory: DataFrame) -> DataFrame:
    """Demand beside the balance of its day: of exactly that product, variety, colour and grade, else of its product and colour."""
    exact, loose = ["order_date", "product", "variety", "color", "grade"], ["order_date", "product", "color"]
    wanted = demand.groupBy(*exact).agg(F.sum("stems").alias("stems"))
    there = inventory.withColumnRenamed("inv_date", "order_date")
    near = there.groupBy(*exact).agg(F.sum("balance").alias("exact_balance"))
    wide = there.groupBy(*loose).agg(F.sum("balance").alias("loose_balance"))
    joined = wanted.join(near, exact, "left").join(wide, loose, "left")
    kind = F.when(F.col("exact_balance").isNotNull(), "EXACTO").when(F.col("loose_balance").isNotNull(), "FLEXIBLE").otherwise("SIN_MATCH")
    return joined.select(*exact, "stems", F.coalesce("exact_balance", "loose_balance").alias("balance"), kind.alias("match"))


def load_weekly_recency(series: DataFrame, periods: tuple[int, ...] = (8, 12, 26, 52)) -> DataFrame:
    """Recency of each client from a weekly series (client, week_start, stems)."""
    last = series.agg(F.max("week_start").alias("last_of_all"))
    dated = series.join(F.broadcast(last))  # one row
    within = lambda n, c: F.when(F.col("week_start") >= F.date_sub("last_of_all", 7 * n), F.col(c))
    days = F.datediff(F.max("last_of_all"), F.max("week_start"))
    return dated.groupBy(*CLIENT).agg(
        F.max("week_start").alias("last_week"), days.alias("days_since"), (days <= 16 * 7).alias("active_16w"),
        *[F.count_distinct(within(n, "week_start")).alias(f"weeks_{n}w") for n in periods],
        *[F.coalesce(F.sum(within(n, "stems")), F.lit(0.0)).alias(f"stems_{n}w") for n in periods],
    )


def cluster_period(df: DataFrame) -> DataFrame:
    """What each calendar year offers for clustering: first and last date, lines and clients."""
    return df.groupBy(F.year("order_date").alias("year")).agg(
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"), F.count(F.lit(1)).alias("lines"), F.count_distinct("client_code").alias("clients")
    )


def cluster_year_change(before: DataFrame, after: DataFrame, label: str = "cluster_id") -> DataFrame:
    """Clients of both years within a market: their label then and now, and whether it stayed."""
    old = before.select("client_code", "market", F.col(label).alias("label_before"), F.col("stems").alias("stems_before"))
    new = after.select("client_code", "market", F.col(label).alias("label_after"), F.col("stems").alias("stems_after"))
    kept = F.when(F.col("label_before").eqNullSafe(F.col("label_after")), "Mantiene tipologia").otherwise("Cambia tipologia")
    return old.join(new, ["client_code", "market"]).withColumn("change", kept)


def year_projection(df: DataFrame) -> DataFrame:
    """Per ISO year its confirmed stems, sales, price and orders; years of less than 52 weeks are stretched to 52."""
    years = df.groupBy("iso_year").agg(
        F.sum("stems_confirmed").alias("stems"), F.sum("sales_usd").alias("sales_usd"), F.count_distinct("order_id").alias("orders"), F.count_distinct("iso_week").alias("weeks")
    )
    to_year = lambda c: F.when(F.col("weeks") >= 52, F.col(c)).otherwise(F.col(c) / F.col("weeks") * 52)
    projected = years.withColumns({"projected_stems": to_year("stems"), "projected_usd": to_year("sales_usd")})
    return projected.withColumns({"price_usd": ratio(F.col("sales_usd"), F.col("stems")), "projected_price": ratio(F.col("projected_usd"), F.col("projected_stems"))})


def validation_windows(validated: DataFrame, sizes: tuple[int, ...] = (2, 5, 8)) -> DataFrame:
    """Per ISO year and size the first weeks of windows whose weeks are all there."""
    weeks = validated.select("iso_year", "iso_week").distinct()
    ahead = lambda n: F.count(F.lit(1)).over(Window.partitionBy("iso_year").orderBy("iso_week").rangeBetween(0, n - 1))
    full = weeks.withColumns({str(n): (ahead(n) == n) & (F.col("iso_week") + n - 1 <= 53) for n in sizes})
    return full.unpivot(["iso_year", "iso_week"], [str(n) for n in sizes], "size", "full").where("full").select("iso_year", F.col("size").cast("int").alias("size"), F.col("iso_week").alias("first_week"))


def forecast_views(predicted: DataFrame, model: str, colors: int = 10, items: int = 100) -> dict[str, DataFrame]:
    """season (by year and week), colors (the largest colours by week), fit (product, colour and week), markets (the largest
    items of markets)."""
    y, p = F.sum("stems").alias("stems"), F.sum(model).alias("forecast")
    top = top_k(predicted.groupBy("color").agg(p), colors, "forecast", "color").select("color")
    by_item = predicted.groupBy("market", "product", "color").agg(p, F.count_distinct("client").alias("clients"))
    return {
        "season": predicted.groupBy("iso_year", "iso_week").agg(y, p),
        "colors": predicted.join(F.broadcast(top), "color", "left_semi").groupBy("week_start", "color").agg(p),  # at most `colors` rows
        "fit": predicted.groupBy("product", "color", "week_start").agg(y, p),
        "markets": top_k(by_item, items, "forecast", "market", "product", "color"),
    }


def season_peak(week: Column) -> Column:
    return week.isin(SEASON_PEAKS).cast("int")


def candidate_structures(daily: DataFrame, active: DataFrame, weeks: list[int], lookback: int = 12) -> DataFrame:
    """Structures of active clients seen in the last weeks, with what they brought lately and in the season of the ISO weeks to
    be forecast (two weeks around each). Days that are both count twice; days, last date and stems rank them."""
    season = sorted({(w + d - 1) % 52 + 1 if d else w for w in weeks for d in range(-2, 3)})
    last = daily.agg(F.max("order_date").alias("last_of_all"))
    of_active = daily.join(active.select(*CLIENT).distinct(), CLIENT, "left_semi").join(F.broadcast(last))  # one row
    recent = (F.col("order_date") >= F.date_sub("last_of_all", 7 * max(lookback, 12))).cast("int")
    near = F.weekofyear("order_date").isin(season).cast("int")
    counted = of_active.withColumns({"recent": recent, "times": recent + near}).where("times > 0")
    per = counted.groupBy(*CLIENT, "product", "color", "order_type").agg(
        F.sum(F.col("stems") * F.col("times")).alias("stems"), F.count_distinct("order_date").alias("days"), F.max("order_date").alias("last_date"), F.max("recent").alias("recent")
    )
    return per.where("recent = 1").drop("recent")
