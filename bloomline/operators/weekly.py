"""Weekly demand of solid lines: dense panel, features without leaks, baselines, two-stage boosting and its backtest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.sources.tables import stored

KEY = ["client", "market", "country", "product", "color"]
# Weeks of the commercial phases.
PHASES = {
    "PRE_SAN_VALENTIN": [4], "PICO_SAN_VALENTIN": [5], "POST_SAN_VALENTIN": [6, 7], "PRE_DIA_MUJER": [8],
    "PICO_DIA_MUJER": [9], "POST_DIA_MUJER": [10], "PRE_MADRES": [16, 17], "PICO_MADRES": [18, 19],
    "POST_MADRES": [20, 21, 22], "PRE_FIN_ANO": [48], "PICO_FIN_ANO": [49, 50], "POST_FIN_ANO": [51, 52],
}
PEAKS = [5, 9, 18, 19, 49, 50]


def select_solids(df: DataFrame) -> DataFrame:
    """Solid lines without marks of mixed formats; confirmed ones, or all where no state is given at all."""
    text = F.lower(F.concat_ws(" ", "pack_order_type", "packaging", "recipe"))
    solid = df.where((F.col("order_type") == "SOLIDO") & ~text.rlike(r"\bcombo\b|\bbqt\b|\bbouquet\b"))
    stated = solid.agg(F.coalesce(F.max((F.col("state_canonical") != "otro").cast("int")), F.lit(0)).alias("any_stated"))
    return solid.join(F.broadcast(stated)).where("any_stated = 0 or state_canonical = 'confirmado'").drop("any_stated")  # one row


def solid_weekly_demand(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEY, "week_start", "iso_year", "iso_week").agg(
        F.sum("stems").alias("stems"), F.sum("stems_confirmed").alias("confirmed"), F.sum("shortfall").alias("shortfall"), F.count(F.lit(1)).alias("lines")
    )


def week_panel(weekly: DataFrame, least_weeks: int = 3, least_stems: float = 500.0, active_weeks: int = 52) -> DataFrame:
    """Every Monday of the range for every key that is strong enough and was active lately; weeks without demand are 0.

    Keys meet the weeks through a generated sequence per key: no join of keys with weeks. The weekly sums are written once."""
    weekly = stored(weekly, "weekly-demand")
    ends = weekly.agg(F.min("week_start").alias("from_week"), F.max("week_start").alias("to_week"))
    strong = weekly.groupBy(*KEY).agg(F.count_distinct("week_start").alias("weeks"), F.sum("stems").alias("total"), F.max("week_start").alias("last_week"))
    keys = strong.join(F.broadcast(ends)).where(  # one row
        ((F.col("weeks") >= least_weeks) | (F.col("total") >= least_stems)) & (F.col("last_week") >= F.date_sub("to_week", 7 * (active_weeks - 1)))
    )
    dense = keys.select(*KEY, F.explode(F.sequence("from_week", "to_week", F.expr("interval 7 days"))).alias("week_start"))
    panel = dense.join(weekly.select(*KEY, "week_start", "stems"), [*KEY, "week_start"], "left").withColumn("stems", F.coalesce("stems", F.lit(0.0)))
    day = F.col("week_start")
    return panel.withColumns({"iso_year": F.extract(F.lit("YEAROFWEEK"), day), "iso_week": F.weekofyear(day), "month": F.month(day)})


def floral_phase(week: Column) -> Column:
    out = None
    for phase, weeks in PHASES.items():
        out = F.when(week.isin(weeks), phase) if out is None else out.when(week.isin(weeks), phase)
    return out.otherwise("REGULAR")


def floral_calendar(week: Column) -> dict[str, Column]:
    phase = floral_phase(week)
    return {
        "phase": phase,
        "is_peak": phase.rlike("^(PRE|PICO)_").cast("int"),
        "is_post": phase.startswith("POST_").cast("int"),
        "peak_distance": F.least(*[F.abs(week - p) for p in PEAKS]),
    }


def market_year_growth(weekly: DataFrame) -> DataFrame:
    """Growth of a market from the year before, clipped, for use in the year after."""
    years = weekly.groupBy("market", "iso_year").agg(F.sum("stems").alias("s"))
    before = F.lag("s").over(Window.partitionBy("market").orderBy("iso_year"))
    growth = F.try_divide("s", before)
    return years.select("market", (F.col("iso_year") + 1).alias("iso_year"), F.when(growth.isNotNull(), F.least(F.greatest(growth, F.lit(0.75)), F.lit(1.35))).alias("growth"))


FROZEN = {"lag_1": 1, "lag_2": 2, "lag_4": 4}
ROLLING = {"mean_4": 4, "median_8": 8, "median_12": 12, "activity_8": 8, "activity_26": 26}


def panel_features(panel: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Lags and rolling figures of the weeks before, the same week a year ago, levels of key, client and market, season.

    history: the rows that levels may be learnt from (default: all); windows never see the current week. The panel is written once, as
    nine figures are made of it."""
    panel = stored(panel, "weekly-panel")
    week = Window.partitionBy(*KEY).orderBy("week_start")
    active = (F.col("stems") > 0).cast("double")
    back = lambda n: week.rowsBetween(-n, -1)
    out = panel.withColumns(
        {
            **{n: F.lag("stems", k).over(week) for n, k in FROZEN.items()},
            "mean_4": F.avg("stems").over(back(4)),
            "median_8": F.percentile("stems", F.lit(0.5)).over(back(8)),
            "median_12": F.percentile("stems", F.lit(0.5)).over(back(12)),
            "activity_8": F.avg(active).over(back(8)),
            "activity_26": F.avg(active).over(back(26)),
        }
    )
    past = panel.select(*KEY, (F.col("iso_year") + 1).alias("iso_year"), "iso_week", F.col("stems").alias("last_year"))
    out = out.join(past, [*KEY, "iso_year", "iso_week"], "left")
    known = history if history is not None else panel
    seen = known.where("stems > 0")
    median = F.percentile("stems", F.lit(0.5))
    levels = [
        (KEY, seen.groupBy(*KEY).agg(median.alias("key_median"), F.count(F.lit(1)).alias("key_weeks"))),
        (["client", "product", "color"], seen.groupBy("client", "product", "color").agg(median.alias("client_item_median"))),
        (["market", "product", "color", "iso_week"], seen.groupBy("market", "product", "color", "iso_week").agg(median.alias("market_week_median"))),
        (["client"], seen.groupBy("client").agg(F.count_distinct("week_start").alias("client_weeks"))),
        (["market", "iso_year"], market_year_growth(seen)),
    ]
    for keys, level in levels:
        out = out.join(level, keys, "left")
    totals = known.groupBy("market", "product", "color", "iso_year", "iso_week").agg(F.sum("stems").alias("s"))
    by_week = totals.groupBy("market", "product", "color", "iso_week").agg(F.percentile("s", F.lit(0.5)).alias("week_level"))
    base = totals.groupBy("market", "product", "color").agg(F.percentile("s", F.lit(0.5)).alias("base_level"))
    index = F.least(F.greatest(F.try_divide("week_level", "base_level"), F.lit(0.0)), F.lit(5.0))
    season = by_week.join(base, ["market", "product", "color"]).select("market", "product", "color", "iso_week", F.when(F.col("base_level") != 0, index).alias("season_index"))
    out = out.join(season, ["market", "product", "color", "iso_week"], "left")
    numbers = [*FROZEN, *ROLLING, "last_year", "key_median", "key_weeks", "client_item_median", "market_week_median", "client_weeks"]
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers})
    out = out.withColumns({c: F.coalesce(c, F.lit(1.0)) for c in ("growth", "season_index")})
    turn = lambda c, n: F.col(c) * F.lit(2 * 3.141592653589793 / n)
    return out.withColumn("last_year_adjusted", F.col("last_year") * F.col("growth")).withColumns(
        {
            "week_sin": F.sin(turn("iso_week", 52)), "week_cos": F.cos(turn("iso_week", 52)),
            "month_sin": F.sin(turn("month", 12)), "month_cos": F.cos(turn("month", 12)), **floral_calendar(F.col("iso_week")),
        }
    )


def freeze_recent(target: DataFrame, history: DataFrame) -> DataFrame:
    """target with each key's last known lags and rolling figures, the same for every week of the horizon."""
    back = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("week_start")))
    ranked = history.select(*KEY, "stems", back.alias("back"))
    within = lambda n: F.when(F.col("back") <= n, F.col("stems"))
    active = lambda n: F.when(F.col("back") <= n, (F.col("stems") > 0).cast("double"))
    anchors = ranked.groupBy(*KEY).agg(
        *[F.max(F.when(F.col("back") == k, F.col("stems"))).alias(n) for n, k in FROZEN.items()],
        F.avg(within(4)).alias("mean_4"),
        F.percentile(within(8), F.lit(0.5)).alias("median_8"),
        F.percentile(within(12), F.lit(0.5)).alias("median_12"),
        F.avg(active(8)).alias("activity_8"),
        F.avg(active(26)).alias("activity_26"),
    )
    names = [*FROZEN, *ROLLING]
    return target.drop(*names).join(anchors, KEY, "left").withColumns({n: F.coalesce(n, F.lit(0.0)) for n in names})


def forecast_baseline_8w(features: DataFrame) -> DataFrame:
    some = lambda c: F.nullif(F.col(c), F.lit(0.0))
    return features.withColumn("baseline_8w", F.coalesce(some("median_8"), some("median_12"), some("client_item_median"), F.lit(0.0)))


def forecast_seasonal_naive(features: DataFrame) -> DataFrame:
    return features.withColumn("seasonal_naive", F.col("last_year"))


def forecast_hybrid(df: DataFrame, model: str) -> DataFrame:
    """The model blended with the adjusted year before: 0.80 of it near peaks, none after them, else 0.40."""
    weight = F.when(F.col("is_peak") > 0, 0.80).when(F.col("is_post") > 0, 0.0).otherwise(0.40)
    season = F.col("last_year_adjusted")
    return df.withColumn("hybrid", F.when(season > 0, weight * season + (1 - weight) * F.col(model)).otherwise(F.col(model)))


FEATURES = [
    *FROZEN, *ROLLING, "last_year_adjusted", "key_median", "key_weeks", "client_item_median", "market_week_median", "client_weeks",
    "season_index", "growth", "week_sin", "week_cos", "month_sin", "month_cos", "is_peak", "is_post", "peak_distance",
]


@dataclass
class TwoStage:
    """Probability of buying, logarithm of the volume if bought, and the factor that gives back what the logarithm loses."""

    buys: GBTClassificationModel
    volumes: GBTRegressionModel
    smear: float


def vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="x").transform(features)


def fit_two_stage(train: DataFrame, trees: int = 20, seed: int = 42) -> TwoStage:
    last = train.agg(F.max("week_start").alias("last_week"))
    age = F.datediff("last_week", "week_start") / 7
    weighted = train.join(F.broadcast(last)).withColumns(  # one row
        {"bought": (F.col("stems") > 0).cast("double"), "y": F.log1p("stems"), "w": F.exp(-age / 104) * F.when(F.col("is_peak") > 0, 1.5).otherwise(1.0)}
    )
    known = stored(vectors(weighted).select("x", "bought", "y", "w"), "weekly-training")
    buys = GBTClassifier(featuresCol="x", labelCol="bought", weightCol="w", maxIter=trees, maxDepth=4, stepSize=0.1, seed=seed).fit(known)
    volumes = GBTRegressor(featuresCol="x", labelCol="y", weightCol="w", maxIter=trees, maxDepth=4, stepSize=0.1, seed=seed).fit(known.where("bought = 1"))
    # Smearing: what the logarithm loses on the training rows, at most 1.35.
    fitted = volumes.transform(known.where("bought = 1")).agg((F.sum(F.expm1("y")) / F.sum(F.expm1("prediction"))).alias("r")).first().r or 1.0
    return TwoStage(buys, volumes, min(max(fitted, 1.0), 1.35))


def forecast_two_stage(train: DataFrame, target: DataFrame, trees: int = 20, seed: int = 42, fitted: TwoStage | None = None) -> DataFrame:
    """target with probability (of buying), volume (if bought) and two_stage, their product below a cap."""
    fitted = fitted or fit_two_stage(train, trees, seed)
    staged = fitted.buys.transform(vectors(target)).withColumn("probability", vector_to_array("probability")[1]).drop("rawPrediction", "prediction")
    volume = F.greatest(F.expm1("prediction") * fitted.smear, F.lit(0.0))
    staged = fitted.volumes.transform(staged).withColumn("volume", volume).drop("prediction", "x")
    anchor = F.greatest("median_8", "median_12", "key_median", "market_week_median", "last_year_adjusted")
    cap = anchor * F.when(F.col("is_peak") > 0, 2.4).otherwise(1.8)
    return staged.withColumn("two_stage", F.least(F.col("probability") * F.col("volume"), cap))


MODELS = ["baseline_8w", "seasonal_naive", "two_stage", "hybrid"]


def forecast_metrics(df: DataFrame, models: list[str], actual: str = "stems", keys: tuple[str, ...] = ()) -> DataFrame:
    """MAE, RMSE, WAPE, MAPE over non-zero weeks and bias per model (and key)."""
    long = df.select(*keys, F.col(actual).alias("y"), *models).unpivot([*keys, "y"], models, "model", "p")
    err = F.col("p") - F.col("y")
    return long.groupBy(*keys, "model").agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.try_divide(F.sum(F.abs(err)), F.sum(F.abs("y"))).alias("wape"),
        F.avg(F.when(F.col("y") != 0, F.abs(err / F.nullif(F.col("y"), F.lit(0.0))))).alias("mape_nonzero"),
        F.try_divide(F.sum(err), F.sum("y")).alias("bias"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("wape", "rmse", "model").limit(1)


def split_weeks(panel: DataFrame, test_weeks: int = 8) -> tuple[DataFrame, DataFrame]:
    last = panel.agg(F.max("week_start").alias("last_week"))
    dated = panel.join(F.broadcast(last))  # one row
    late = F.col("week_start") > F.date_sub("last_week", 7 * test_weeks)
    return dated.where(~late).drop("last_week"), dated.where(late).drop("last_week")


def forecast_backtest(panel: DataFrame, test_weeks: int = 8, trees: int = 20) -> DataFrame:
    """The last weeks predicted by all models from what was known before them. The features are written once: fitting reads
    them many times."""
    panel = stored(panel, "weekly-backtest")
    train, _ = split_weeks(panel, test_weeks)
    featured = stored(panel_features(panel, train), "weekly-features")
    known, target = split_weeks(featured, test_weeks)
    frozen = freeze_recent(target, train)
    staged = forecast_two_stage(known, frozen, trees)
    return forecast_hybrid(forecast_seasonal_naive(forecast_baseline_8w(staged)), "two_stage").select(*KEY, "week_start", "iso_year", "iso_week", "stems", "probability", "volume", *MODELS)


def future_weeks(weekly: DataFrame, weeks: int = 8) -> DataFrame:
    """Every key for each of the weeks after the last one of all, without demand."""
    last = weekly.agg(F.max("week_start").alias("last_week"))
    dated = weekly.select(*KEY).distinct().join(F.broadcast(last))  # one row
    ahead = F.sequence(F.date_add("last_week", 7), F.date_add("last_week", 7 * weeks), F.expr("interval 7 days"))
    day = F.col("week_start")
    return dated.select(*KEY, F.explode(ahead).alias("week_start"), F.lit(0.0).alias("stems")).withColumns(
        {"iso_year": F.extract(F.lit("YEAROFWEEK"), day), "iso_week": F.weekofyear(day), "month": F.month(day)}
    )


def future_forecast(weekly: DataFrame, model: str = "hybrid", weeks: int = 8, trees: int = 20) -> DataFrame:
    """The coming weeks of every key by one of MODELS, where it expects stems. Models are fitted on the panel of strong keys;
    all keys get a forecast."""
    past = stored(week_panel(weekly, least_weeks=0, least_stems=0.0, active_weeks=100_000), "weekly-past")
    featured = panel_features(past.unionByName(future_weeks(weekly, weeks)), past)
    out = freeze_recent(split_weeks(featured, weeks)[1], past)
    if model in ("two_stage", "hybrid"):
        out = forecast_two_stage(panel_features(week_panel(weekly)), out, trees)
    out = forecast_seasonal_naive(forecast_baseline_8w(out))
    out = forecast_hybrid(out, "two_stage") if model == "hybrid" else out
    return out.select(*KEY, "week_start", "iso_year", "iso_week", F.col(model).alias("forecast")).where("forecast > 0")


def wape_by_grain(predicted: DataFrame, keys: list[str], model: str) -> DataFrame:
    """WAPE after summing to another grain."""
    per = predicted.groupBy(*keys).agg(F.sum("stems").alias("y"), F.sum(model).alias("p"))
    return per.agg(F.try_divide(F.sum(F.abs(F.col("p") - F.col("y"))), F.sum(F.abs("y"))).alias("wape"), F.count(F.lit(1)).alias("groups"))


def market_calibration(predicted: DataFrame, model: str, least: float = 1.05, least_stems: float = 100_000.0) -> DataFrame:
    """Markets that were under-forecast in both halves of the test: factor between 1 and 2, others 1."""
    half = F.ntile(2).over(Window.partitionBy("market").orderBy("week_start"))
    weeks = predicted.groupBy("market", "week_start").agg(F.sum("stems").alias("y"), F.sum(model).alias("p")).withColumn("half", half)
    part = lambda c, h: F.sum(F.when(F.col("half") == h, F.col(c)))
    per = weeks.groupBy("market").agg(
        F.try_divide(part("y", 1), part("p", 1)).alias("first"), F.try_divide(part("y", 2), part("p", 2)).alias("second"),
        F.try_divide(F.sum("y"), F.sum("p")).alias("whole"), F.sum("y").alias("stems"),
    )
    short = (F.col("first") >= least) & (F.col("second") >= least) & (F.col("stems") >= least_stems)
    return per.withColumn("factor", F.when(short, F.least(F.greatest("whole", F.lit(1.0)), F.lit(2.0))).otherwise(1.0))


def apply_calibration(predicted: DataFrame, calibration: DataFrame, model: str) -> DataFrame:
    factors = calibration.select("market", "factor")
    joined = predicted.join(factors, "market", "left").withColumn("factor", F.coalesce("factor", F.lit(1.0)))
    return joined.withColumns({model: F.col(model) * F.col("factor"), "calibrated": F.col("factor") > 1})


def seasonal_overlay(df: DataFrame, model: str) -> DataFrame:
    season = F.col("last_year_adjusted")
    return df.withColumn("overlay", F.when((F.col("is_peak") > 0) & (season > 0), 0.75 * season + 0.25 * F.col(model)).otherwise(F.col(model)))


def historical_validation(weekly: DataFrame) -> DataFrame:
    """Every year against the year before it: weeks that only one of them has count as 0 in the other."""
    keys = [*KEY, "iso_year", "iso_week"]
    now = weekly.groupBy(*keys).agg(F.sum("stems").alias("actual"))
    before = now.select(*KEY, (F.col("iso_year") + 1).alias("iso_year"), "iso_week", F.col("actual").alias("predicted"))
    years = weekly.agg(F.min("iso_year").alias("low"), F.max("iso_year").alias("high"))
    both = now.join(before, keys, "outer").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("actual", "predicted")})
    return both.join(F.broadcast(years)).where("iso_year > low and iso_year <= high").drop("low", "high")  # one row


def validation_by_year(validated: DataFrame) -> DataFrame:
    err = F.abs(F.col("predicted") - F.col("actual"))
    return validated.groupBy("market", "iso_year").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.try_divide(F.sum(err), F.sum("actual")).alias("wape"),
        F.try_divide(F.sum(F.col("predicted") - F.col("actual")), F.sum("actual")).alias("bias"),
    )


def forecast_scenario(predicted: DataFrame, probability_factor: float, volume_factor: float) -> DataFrame:
    """Per week the expected stems as they are and with probability and volume changed."""
    base = F.col("probability") * F.col("volume")
    changed = F.least(F.col("probability") * probability_factor, F.lit(1.0)) * F.col("volume") * volume_factor
    return predicted.groupBy("iso_year", "iso_week").agg(F.sum(base).alias("base"), F.sum(changed).alias("scenario"))
