"""Selections, windows and summaries over cleaned lines, weekly demand and forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import MISSING, normalize_client_code, ratio  # noqa: F401
from bloomline.operators.profile import CLIENT
from bloomline.operators.structures import lately

# The scopes and their order types.
SCOPES = {"solids": ["SOLIDO"], "structures": ["SURTIDO", "SURTIDO_M", "RAINBOW", "BQT", "BOUQUET", "COMBO"], "bulk": ["BULK"]}


def filter_scope(df: DataFrame, scope: str = "all") -> DataFrame:
    """Lines of one scope of order types; any other name means all."""
    return df.where(F.col("order_type").isin(SCOPES[scope])) if scope in SCOPES else df


def filter_by(df: DataFrame, **wanted) -> DataFrame:
    """Rows whose columns hold one of the wanted values; None and empty lists select everything."""
    for column, values in wanted.items():
        if values:
            df = df.where(F.col(column).isin(values))
    return df


def filter_sales(df: DataFrame, years: list[int] | None = None, weeks: tuple[int, int] | None = None, **wanted) -> DataFrame:
    """Sales lines of years, a range of ISO weeks and column values."""
    out = filter_by(df, iso_year=years, **wanted)
    return out.where(F.col("iso_week").between(*weeks)) if weeks else out


def visible_sku(df: DataFrame) -> Column:
    """The SKU that a view shows: the operational one, else the flexible one."""
    return F.coalesce(F.nullif(F.col("sku_operational"), F.lit(MISSING)), F.col("sku_flexible"))


def filter_operational(df: DataFrame, skus: list[str] | None = None, **wanted) -> DataFrame:
    out = filter_by(df.withColumn("visible_sku", visible_sku(df)), **wanted)
    return out.where(F.col("visible_sku").isin(skus)) if skus else out


def analysis_windows(df: DataFrame, weeks: int = 12) -> DataFrame:
    """Lines of the last weeks before the latest Monday (included), and of the same weeks 52 weeks before, marked in window."""
    last = df.agg(F.max("week_start").alias("last_week"))
    placed = df.join(F.broadcast(last))  # one row
    age = F.datediff("last_week", "week_start") / 7
    window = F.when(age < weeks, "current").when((age >= 52) & (age < 52 + weeks), "year_before")
    return placed.withColumn("window", window).where("window is not null").drop("last_week")


def future_window(df: DataFrame, date: str = "order_date", offset: int = 0, weeks: int = 8) -> DataFrame:
    """Rows of the visible weeks: they begin offset weeks after the first date."""
    first = df.agg(F.min(date).alias("first_date"))
    start = F.date_add("first_date", 7 * offset)
    dated = df.join(F.broadcast(first))  # one row
    return dated.where((F.col(date) >= start) & (F.col(date) < F.date_add(start, 7 * weeks))).drop("first_date")


def recent_real_demand(history: DataFrame, demand: DataFrame, weeks: int = 3) -> DataFrame:
    """Stems of real orders by date and product in the weeks before the first date of the demand."""
    start = demand.agg(F.min("order_date").alias("start"))
    dated = history.join(F.broadcast(start))  # one row
    near = dated.where((F.col("order_date") < F.col("start")) & (F.col("order_date") >= F.date_sub("start", 7 * weeks)))
    return near.groupBy("order_date", "product").agg(F.sum("stems").alias("stems"))


def sku_summary(df: DataFrame, weeks: int = 12) -> DataFrame:
    """Per client and operational SKU of the recent weeks: volume, weeks, orders, share, fulfilment, stems of a usual week."""
    per_week = lately(df, weeks).groupBy(*CLIENT, "sku_operational", "year_week").agg(
        F.sum("stems").alias("s"), F.sum("stems_confirmed").alias("c"), F.count_distinct("order_id").alias("orders")
    )
    per = per_week.groupBy(*CLIENT, "sku_operational").agg(
        F.sum("s").alias("stems"), F.count(F.lit(1)).alias("weeks"), F.sum("orders").alias("orders"),
        F.percentile("s", F.lit(0.5)).alias("usual_week"), ratio(F.sum("c"), F.sum("s")).alias("fulfilment"),
    )
    return per.withColumn("share", ratio(F.col("stems"), F.sum("stems").over(Window.partitionBy(*CLIENT))))


def client_structures(df: DataFrame, weeks: int = 12) -> DataFrame:
    """Per client and structure the whole history beside the recent weeks, and whether it is still bought."""
    last = df.agg(F.max("order_date").alias("last_date"))
    dated = df.join(F.broadcast(last))  # one row
    now = F.col("order_date") >= F.date_sub("last_date", 7 * weeks)
    per = dated.groupBy(*CLIENT, "structure_key").agg(
        F.sum("stems").alias("stems"), F.count_distinct("year_week").alias("weeks"),
        F.sum(F.when(now, F.col("stems")).otherwise(0.0)).alias("recent_stems"),
        F.count_distinct(F.when(now, F.col("year_week"))).alias("recent_weeks"),
        ratio(F.sum("stems_confirmed"), F.sum("stems")).alias("fulfilment"),
    )
    return per.withColumn("current", F.col("recent_weeks") > 0)


def typical_week_lookup(df: DataFrame, week: int) -> DataFrame:
    """One ISO week over the years, per client: mean and years in which it was bought."""
    years = df.where(F.col("iso_week") == week).groupBy(*CLIENT, "iso_year").agg(F.sum("stems").alias("s"))
    return years.groupBy(*CLIENT).agg(F.count(F.lit(1)).alias("years"), F.avg("s").alias("mean_stems"), F.max("s").alias("most_stems"))


def week_detail(df: DataFrame, year: int, week: int) -> DataFrame:
    """What was ordered in one ISO week, by client and product."""
    of_week = df.where((F.col("iso_year") == year) & (F.col("iso_week") == week))
    return of_week.groupBy(*CLIENT, "product").agg(F.sum("stems").alias("stems"), F.count_distinct("order_id").alias("orders"))


def source_summary(weekly: DataFrame) -> DataFrame:
    """One row on what the demand covers."""
    return weekly.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("stems").alias("stems"), F.min("week_start").alias("first_week"),
        F.max("week_start").alias("last_week"), F.count_distinct("client").alias("clients"), F.count_distinct("product").alias("products"),
    )


def filter_forecast(df: DataFrame, since: str | None = None, until: str | None = None, **wanted) -> DataFrame:
    out = filter_by(df, **wanted)
    if since:
        out = out.where(F.col("week_start") >= F.lit(since).cast("date"))
    return out.where(F.col("week_start") <= F.lit(until).cast("date")) if until else out


def forecast_summaries(predicted: DataFrame, model: str) -> dict[str, DataFrame]:
    """by_week, by_item (market, product, colour) and errors by market."""
    y, p = F.sum("stems").alias("stems"), F.sum(model).alias("forecast")
    error = F.try_divide(F.sum(F.abs(F.col(model) - F.col("stems"))), F.sum("stems")).alias("wape")
    return {
        "by_week": predicted.groupBy("week_start").agg(y, p),
        "by_item": predicted.groupBy("market", "product", "color").agg(y, p),
        "errors": predicted.groupBy("market").agg(y, p, error),
    }


def validation_by_window(validated: DataFrame, sizes: tuple[int, ...] = (2, 5, 8)) -> DataFrame:
    """Real, predicted, WAPE and bias over the complete windows of so many weeks of a year, after summing each window."""
    starts = F.explode(F.array(*[F.lit(n) for n in sizes])).alias("size")
    weekly = validated.groupBy("iso_year", "iso_week").agg(F.sum("actual").alias("y"), F.sum("predicted").alias("p"))
    placed = weekly.select("*", starts).withColumn("window", F.floor((F.col("iso_week") - 1) / F.col("size")).cast("int"))
    per = placed.groupBy("iso_year", "size", "window").agg(F.sum("y").alias("y"), F.sum("p").alias("p"), F.count(F.lit(1)).alias("n"))
    return per.where(F.col("n") == F.col("size")).groupBy("iso_year", "size").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("y").alias("actual"), F.sum("p").alias("predicted"),
        F.try_divide(F.sum(F.abs(F.col("p") - F.col("y"))), F.sum("y")).alias("wape"), F.try_divide(F.sum(F.col("p") - F.col("y")), F.sum("y")).alias("bias"),
    )


def daily_aggregate(df: DataFrame) -> DataFrame:
    """Stems and lines per day and structure of demand."""
    return df.groupBy(*CLIENT, "order_date", "product", "color", "order_type").agg(F.sum("stems").alias("stems"), F.count(F.lit(1)).alias("lines"))


def lag_weeks(daily: DataFrame, keys: list[str], lags: tuple[int, ...] = (1, 2, 4, 8)) -> DataFrame:
    """daily with the stems of exactly so many weeks before: the shifted rows are gathered in one aggregate, not one join per
    lag."""
    here = daily.select(*keys, "order_date", "stems", F.lit(0).alias("lag"), F.col("stems").alias("s"))
    shifted = daily.select(*keys, "stems", "order_date", F.explode(F.array(*[F.lit(n) for n in lags])).alias("lag"))
    later = shifted.select(*keys, F.date_add("order_date", F.col("lag") * 7).alias("order_date"), F.lit(None).cast("double").alias("stems"), "lag", F.col("stems").alias("s"))
    summed = here.unionByName(later).groupBy(*keys, "order_date").agg(
        F.max("stems").alias("stems"), *[F.coalesce(F.sum(F.when(F.col("lag") == n, F.col("s"))), F.lit(0.0)).alias(f"lag_{n}w") for n in lags]
    )
    return summed.where("stems is not null")


def category_codes(df: DataFrame, column: str, most: int = 178) -> DataFrame:
    """value and code: the commonest values from 2 on, 1 for missing text; all others have no row and count as 0."""
    counts = df.where(F.col(column) != MISSING).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "value").limit(most)  # at most `most` rows are numbered in one task
    numbered = top.withColumn("code", F.row_number().over(Window.orderBy(F.desc("n"), "value")) + 1).select("value", "code")
    return numbered.unionByName(df.sparkSession.range(1).select(F.lit(MISSING).alias("value"), F.lit(1).alias("code")))


def history_stats(df: DataFrame, keys: list[str], windows: tuple[int, ...] = (4, 8, 12, 52)) -> DataFrame:
    """Medians of a key's daily stems over the whole history and the last weeks, and how many days there are."""
    daily = df.groupBy(*keys, "order_date").agg(F.sum("stems").alias("s"))
    last = daily.agg(F.max("order_date").alias("last_date"))
    dated = daily.join(F.broadcast(last))  # one row
    within = lambda n: F.when(F.col("order_date") > F.date_sub("last_date", 7 * n), F.col("s"))
    return dated.groupBy(*keys).agg(
        F.percentile("s", F.lit(0.5)).alias("median_all"), F.count(F.lit(1)).alias("days"),
        *[F.percentile(within(n), F.lit(0.5)).alias(f"median_{n}w") for n in windows],
    )
