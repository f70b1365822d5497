"""Projected inventory, its cross with demand, and purchase priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import ratio
from bloomline.operators.mix import top_k
from bloomline.sources.tables import stored

ITEM = ["product", "variety", "color", "grade"]
COLOR = ["product", "color", "grade"]
EASY = ["SOLIDO", "SURTIDO", "SURTIDO_M"]


def short(x: Column) -> Column:
    return F.greatest(-x, F.lit(0.0))


def spare(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def status(x: Column, suffix: str = "") -> Column:
    return F.when(x < 0, f"FALTANTE{suffix}").when(x > 0, f"SOBRANTE{suffix}").otherwise(f"NEUTRO{suffix}")


def _balances(df: DataFrame, column: str, suffix: str = "") -> DataFrame:
    b = F.col(column)
    return df.withColumns({"short": short(b), "spare": spare(b), "status": status(b, suffix)})


def inventory_item_day(inv: DataFrame) -> DataFrame:
    per = inv.groupBy("inv_date", "year_week", *ITEM).agg(F.sum("balance").alias("balance"), F.count_distinct("farm").alias("farms"))
    return _balances(per, "balance")


def inventory_farm_day(inv: DataFrame) -> DataFrame:
    per = inv.groupBy("inv_date", *ITEM, "farm").agg(F.sum("balance").alias("balance"))
    return per.withColumn("status", status(F.col("balance")))


def inventory_item_week(inv: DataFrame) -> DataFrame:
    per = inv.groupBy("year_week", *ITEM).agg(F.sum("balance").alias("balance"))
    return per.withColumns({"short": short(F.col("balance")), "spare": spare(F.col("balance"))})


def inventory_color_day(inv: DataFrame) -> DataFrame:
    per = inv.groupBy("inv_date", "year_week", *COLOR).agg(
        F.sum("balance").alias("balance"), F.count_distinct("variety").alias("varieties"), F.count_distinct("farm").alias("farms")
    )
    return _balances(per, "balance", "_COLOR")


def demand_inventory_cross(demand: DataFrame, inv: DataFrame) -> DataFrame:
    """demand (demand_date, product, variety, color, grade, ...) with the balances of its variety and its colour."""
    by_variety = inv.groupBy(F.col("inv_date").alias("demand_date"), *ITEM).agg(F.sum("balance").alias("variety_balance"), F.count_distinct("farm").alias("farms"))
    by_color = inv.groupBy(F.col("inv_date").alias("demand_date"), *COLOR).agg(F.sum("balance").alias("color_balance"), F.count_distinct("variety").alias("varieties"))
    joined = demand.join(by_variety, ["demand_date", *ITEM], "left").join(by_color, ["demand_date", *COLOR], "left")
    filled = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("variety_balance", "farms", "color_balance", "varieties")})
    color, variety = F.col("color_balance"), F.col("variety_balance")
    return filled.withColumns(
        {
            "color_short": short(color), "color_spare": spare(color), "variety_short": short(variety), "variety_spare": spare(variety),
            "risk": F.when(color < 0, "ALTO_FALTANTE_COLOR").when(color == 0, "SIN_SOBRANTE_COLOR").otherwise("CON_SOBRANTE_COLOR"),
            "variety_risk": F.when(variety < 0, "FALTANTE_VARIEDAD").when(variety == 0, "SIN_SOBRANTE_VARIEDAD").otherwise("CON_SOBRANTE_VARIEDAD"),
        }
    )


def is_usa(country: Column) -> Column:
    return F.upper(F.coalesce(country, F.lit(""))).rlike(r"\bUSA\b|UNITED STATES|ESTADOS UNIDOS|EEUU")


def variety_demand_rank(demand: DataFrame) -> DataFrame:
    """Share and dense rank of each variety in its colour's demand outside the USA."""
    per = demand.where(~is_usa(F.col("country"))).groupBy(*ITEM).agg(F.sum("stems").alias("s"))
    whole = Window.partitionBy(*COLOR)
    return per.select(
        *ITEM, ratio(F.col("s"), F.sum("s").over(whole)).alias("variety_share"), F.dense_rank().over(whole.orderBy(F.desc("s"))).alias("variety_rank")
    )


def purchase_priority(crossed: DataFrame) -> DataFrame:
    """crossed: demand_inventory_cross of demand with country, order_type, source and score; written once, as the ranks are made of it, too."""
    crossed = stored(crossed, "priority-crossed")
    ranked = crossed.join(variety_demand_rank(crossed), ITEM, "left").withColumn("variety_share", F.coalesce("variety_share", F.lit(0.0)))
    usa, easy, rainbow = is_usa(F.col("country")), F.col("order_type").isin(EASY), F.col("order_type") == "RAINBOW"
    pending, score = F.col("source") == "PENDIENTE_REAL_CLIENTE", F.coalesce("score", F.lit(0.0))
    high, even = F.col("risk") == "ALTO_FALTANTE_COLOR", F.col("risk") == "SIN_SOBRANTE_COLOR"
    buy = ~usa & easy & high
    return ranked.withColumns(
        {
            "stems_to_buy": F.when((F.col("color_balance") < 0) & ~usa & easy, F.least("stems", "color_short")).otherwise(0.0),
            "priority": F.when(rainbow & high, "RAINBOW_NO_COMPRAR_ARMAR_CON_REGLA_GENERAL")
            .when(usa & high, "USA_VALIDAR_ANTES_DE_COMPRAR")
            .when(buy & pending, "ORDEN_REAL_NO_USA_COMPRAR_SOLIDO_SURTIDO_PRIORIDAD_ALTA")
            .when(buy & (score >= 80), "NO_USA_COMPRAR_VARIEDAD_TOP_PRIORIDAD_ALTA")
            .when(buy & (score >= 65), "NO_USA_PILOTO_COMPRA_VARIEDAD_TOP")
            .when(buy, "NO_USA_COMPRAR_COLOR_BASE_VALIDAR_VARIEDAD")
            .when(even & pending, "ORDEN_REAL_PENDIENTE_VIGILAR")
            .when(even & (score >= 65), "VIGILAR_DISPONIBILIDAD")
            .otherwise("SIN_PRIORIDAD_COMPRA"),
            "variety_rule": F.when(rainbow, "no_comprar_rainbow_como_terminado")
            .when(usa, "usa_no_define_compra_variedad")
            .when(F.col("variety_rank") == 1, "variedad_top_no_usa")
            .when(F.col("variety_share") >= 0.25, "variedad_relevante_no_usa")
            .otherwise("variedad_secundaria_o_sin_demanda_no_usa"),
        }
    )


def buyer(prioritised: DataFrame, keys: list[str], k: int | None = None) -> DataFrame:
    """What to buy per key; with k the largest k by stems to buy."""
    per = prioritised.groupBy(*keys).agg(
        F.sum("stems").alias("stems"), F.sum("stems_to_buy").alias("stems_to_buy"), F.count(F.lit(1)).alias("lines"), F.count_distinct("client_code").alias("clients")
    )
    return top_k(per, k, "stems_to_buy", *keys) if k else per


def color_balance(demand: DataFrame, inv: DataFrame) -> DataFrame:
    """Per date and colour: balance, demand, orders and what is left."""
    have = inv.groupBy(F.col("inv_date").alias("demand_date"), "product", "color").agg(F.sum("balance").alias("balance"))
    want = demand.groupBy("demand_date", "product", "color").agg(F.sum("stems").alias("demand"), F.count_distinct("order_id").alias("orders"))
    joined = have.join(want, ["demand_date", "product", "color"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("demand", "orders")})
    return joined.withColumns({"short": short(F.col("balance")), "status": status(F.col("balance"))})


def color_balance_day(balance: DataFrame) -> DataFrame:
    return balance.groupBy("demand_date", "status").agg(F.sum("short").alias("short"), F.count(F.lit(1)).alias("colors"))


def color_shortage_top(balance: DataFrame, k: int = 20) -> DataFrame:
    per = balance.where("short > 0").groupBy("product", "color").agg(F.sum("short").alias("short"), F.count_distinct("demand_date").alias("days_short"))
    return top_k(per, k, "short", "product", "color")


def shortage_lines(demand: DataFrame, balance: DataFrame, keys: list[str]) -> DataFrame:
    """Demand on days when its colour is short, by any keys."""
    days = balance.where("short > 0").select("demand_date", "product", "color").distinct()
    hit = demand.join(days, ["demand_date", "product", "color"], "left_semi")
    return hit.groupBy(*keys).agg(F.sum("stems").alias("stems"), F.count_distinct("order_id").alias("orders"))


def demand_totals(demand: DataFrame, keys: list[str]) -> DataFrame:
    return demand.groupBy(*keys).agg(F.sum("stems").alias("stems"), F.count(F.lit(1)).alias("lines"))


def demand_vs_last_year(demand: DataFrame, past: DataFrame) -> DataFrame:
    """Demand per ISO week against the same week of the year before."""
    now = demand.groupBy("iso_year", "iso_week").agg(F.sum("stems").alias("stems"))
    before = past.groupBy((F.col("iso_year") + 1).alias("iso_year"), "iso_week").agg(F.sum("stems").alias("last_year"))
    joined = now.join(before, ["iso_year", "iso_week"], "left").withColumn("last_year", F.coalesce("last_year", F.lit(0.0)))
    diff = F.col("stems") - F.col("last_year")
    return joined.withColumns({"difference": diff, "pct": F.try_divide(diff, F.col("last_year"))})
