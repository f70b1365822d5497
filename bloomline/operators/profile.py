"""Client profile: volumes, recency, concentration, variety and the scores made of them."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import ratio
from bloomline.sources.tables import stored_once

CLIENT = ["client_code", "client"]
WINDOWS = (8, 12, 26, 52)
TOP_SHARES = [
    ("sku_finished", 5, "top5_sku_finished"), ("sku_flexible", 5, "top5_sku_flexible"), ("color", 3, "top3_color"),
    ("product_color", 5, "top5_product_color"), ("pack_key", 3, "top3_pack"), ("order_type", 1, "top1_order_type"),
    ("structure_key", 3, "top3_structure"), ("analysis_key", 5, "top5_analysis"),
]
ENTROPIES = ["color", "sku_finished", "pack_key", "order_type", "structure_key", "analysis_key"]
SIMILARITIES = ["color", "sku_finished", "sku_flexible", "order_type", "structure_key", "analysis_key"]


def client_weekly_base(df: DataFrame) -> DataFrame:
    """Per client and week: sums and exact distinct counts."""
    return df.groupBy(*CLIENT, "year_week").agg(
        F.sum("stems").alias("week_stems"),
        F.sum("stems_confirmed").alias("week_confirmed"),
        F.sum("shortfall").alias("week_shortfall"),
        F.count_distinct("product").alias("products"),
        F.count_distinct("color").alias("colors"),
        F.count_distinct("variety").alias("varieties"),
        F.count_distinct("sku_finished").alias("skus_finished"),
        F.count_distinct("sku_flexible").alias("skus_flexible"),
        F.count_distinct("order_type").alias("order_types"),
        F.count_distinct("order_date").alias("dates"),
    )


def client_volume_stats(df: DataFrame) -> DataFrame:
    weeks = df.agg(F.greatest(F.count_distinct("year_week"), F.lit(1)).alias("weeks_observed"))
    per = client_weekly_base(df).groupBy(*CLIENT).agg(
        F.count(F.lit(1)).alias("active_weeks"),
        F.sum("week_stems").alias("stems"),
        F.avg("week_stems").alias("mean_week"),
        F.percentile("week_stems", F.lit(0.5)).alias("median_week"),
        F.stddev_samp("week_stems").alias("std_week"),
        F.min("week_stems").alias("min_week"),
        F.max("week_stems").alias("max_week"),
        F.avg("products").alias("mean_products"),
        F.avg("colors").alias("mean_colors"),
        F.avg("varieties").alias("mean_varieties"),
        F.avg("skus_finished").alias("mean_skus_finished"),
        F.avg("skus_flexible").alias("mean_skus_flexible"),
        F.avg("order_types").alias("mean_order_types"),
        F.sum("week_confirmed").alias("confirmed"),
        F.sum("week_shortfall").alias("shortfall"),
    )
    joined = per.join(F.broadcast(weeks))  # one row
    return joined.withColumns(
        {
            "active_share": F.col("active_weeks") / F.col("weeks_observed"),
            "cv": ratio(F.coalesce("std_week", F.lit(0.0)), F.col("mean_week")),
            "fulfilment": F.least(F.greatest(ratio(F.col("confirmed"), F.col("stems")), F.lit(0.0)), F.lit(1.0)),
        }
    )


def client_recency(df: DataFrame, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """First and last date, days since the last over all clients, and activity in inclusive windows before it."""
    last = df.agg(F.max("order_date").alias("last_of_all"))
    dated = df.join(F.broadcast(last))  # one row
    inside = {w: F.col("order_date") >= F.date_sub("last_of_all", 7 * w) for w in windows}
    days = F.datediff(F.max("last_of_all"), F.max("order_date"))
    return dated.groupBy(*CLIENT).agg(
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        days.cast("int").alias("days_since"),
        *[F.count_distinct(F.when(c, F.col("year_week"))).alias(f"active_weeks_{w}w") for w, c in inside.items()],
        *[F.sum(F.when(c, F.col("stems")).otherwise(0.0)).alias(f"stems_{w}w") for w, c in inside.items()],
        (days <= 112).alias("active_16w"),
    )


def long_form(df: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """A row per line and column: client, keys, dimension (the column's name), value, stems. The lines are read once, however
    many columns a figure is wanted for, and grouping by dimension combines them before the shuffle."""
    columns = list(dict.fromkeys(columns))
    narrow = df.select(*CLIENT, *keys, "stems", *[F.col(c).cast("string").alias(f"v_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(f"v_{c}").alias("value")) for c in columns])
    return narrow.select(*CLIENT, *keys, "stems", F.inline(pairs))


def top_shares(df: DataFrame, wanted: list[tuple[str, int, str]]) -> DataFrame:
    """Shares of a client's stems in the n largest values of columns; ties by value. wanted: column, n, name."""
    per = long_form(df, [c for c, _, _ in wanted]).groupBy(*CLIENT, "dimension", "value").agg(F.sum("stems").alias("s"))
    place = F.row_number().over(Window.partitionBy(*CLIENT, "dimension").orderBy(F.desc("s"), "value"))
    ranked = per.withColumn("place", place)
    of = lambda c: F.col("dimension") == c
    top = lambda c, n: F.sum(F.when(of(c) & (F.col("place") <= n), F.col("s")))
    return ranked.groupBy(*CLIENT).agg(*[ratio(top(c, n), F.sum(F.when(of(c), F.col("s")))).alias(name) for c, n, name in wanted])


def top_share(df: DataFrame, column: str, n: int, name: str) -> DataFrame:
    return top_shares(df, [(column, n, name)])


def client_top_share(df: DataFrame) -> DataFrame:
    return top_shares(df, TOP_SHARES)


def entropies(df: DataFrame, columns: list[str], prefix: str = "entropy_") -> DataFrame:
    """Normalised Shannon entropies of a client's stems over columns' values; 0 with at most one positive share."""
    per = long_form(df, columns).groupBy(*CLIENT, "dimension", "value").agg(F.sum("stems").alias("s"))
    shares = per.withColumn("p", F.try_divide("s", F.sum("s").over(Window.partitionBy(*CLIENT, "dimension"))))
    positive = F.when(F.col("p") > 0, F.col("p"))
    n = F.count(positive)
    ent = F.when(n > 1, -F.sum(positive * F.log(positive)) / F.log(n)).otherwise(0.0)
    each = shares.groupBy(*CLIENT, "dimension").agg(ent.alias("e"))
    return each.groupBy(*CLIENT).agg(*[F.max(F.when(F.col("dimension") == c, F.col("e"))).alias(f"{prefix}{c}") for c in columns])


def client_entropy(df: DataFrame) -> DataFrame:
    return entropies(df, ENTROPIES)


def week_similarities(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and least cosine between the mixes of neighbouring observed weeks of a client, by column; 0 with one week.

    A value meets itself in the week before by a lag over its own weeks: no join."""
    per = long_form(df, columns, "year_week").groupBy(*CLIENT, "dimension", "year_week", "value").agg(F.sum("stems").alias("s"))
    ranked = per.withColumn("rank", F.dense_rank().over(Window.partitionBy(*CLIENT, "dimension").orderBy("year_week")))
    own = Window.partitionBy(*CLIENT, "dimension", "value").orderBy("rank")
    # A missing value is no match for itself.
    follows = (F.lag("rank").over(own) == F.col("rank") - 1) & F.col("value").isNotNull()
    met = ranked.withColumn("before", F.when(follows, F.lag("s").over(own)).otherwise(0.0))
    weeks = met.groupBy(*CLIENT, "dimension", "rank").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("norm"), F.sum(F.col("s") * F.col("before")).alias("dot"))
    norm_before = F.lag("norm").over(Window.partitionBy(*CLIENT, "dimension").orderBy("rank"))
    cosine = F.when(F.col("rank") > 1, ratio(F.col("dot"), F.col("norm") * F.col("norm_before")))
    each = weeks.withColumn("norm_before", norm_before).groupBy(*CLIENT, "dimension").agg(
        F.coalesce(F.avg(cosine), F.lit(0.0)).alias("mean"), F.coalesce(F.min(cosine), F.lit(0.0)).alias("least")
    )
    of = lambda c, x: F.max(F.when(F.col("dimension") == c, F.col(x)))
    return each.groupBy(*CLIENT).agg(*[x for c in columns for x in (of(c, "mean").alias(f"similarity_{c}"), of(c, "least").alias(f"similarity_min_{c}"))])


def weekly_mix_similarity(df: DataFrame) -> DataFrame:
    return week_similarities(df, SIMILARITIES)


def minmax_score(df: DataFrame, columns: list[str], low_is_good: bool = True) -> DataFrame:
    """df with score_<column>: 0 to 100 between the column's extremes over all rows; one value throughout is 100 if it is
    positive, else 0 (turned round where low is good)."""
    ends = df.agg(*[f(F.coalesce(F.col(c), F.lit(0.0))).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    out = df.join(F.broadcast(ends))  # one row
    for c in columns:
        lo, hi, x = F.col(f"lo_{c}"), F.col(f"hi_{c}"), F.coalesce(F.col(c), F.lit(0.0))
        score = F.when(lo == hi, F.when(hi > 0, 100.0).otherwise(0.0)).otherwise(F.try_divide(x - lo, hi - lo) * 100)
        out = out.withColumn(f"minmax_{c}", 100 - score if low_is_good else score).drop(f"lo_{c}", f"hi_{c}")
    return out


SHARE_TYPES = ["SOLIDO", "SURTIDO", "SURTIDO_M", "RAINBOW", "BQT", "COMBO", "BOUQUET", "BULK"]


def client_type_shares(df: DataFrame) -> DataFrame:
    total = F.sum("stems")
    shares = df.groupBy(*CLIENT).agg(
        *[ratio(F.sum(F.when(F.col("order_type") == t, F.col("stems")).otherwise(0.0)), total).alias(f"share_{t.lower()}") for t in SHARE_TYPES]
    )
    easy = sum((F.col(f"share_{t}") for t in ("surtido", "surtido_m")), F.col("share_solido"))
    mixed = sum((F.col(f"share_{t}") for t in ("surtido_m", "rainbow", "bouquet", "bqt", "combo")), F.col("share_surtido"))
    return shares.withColumns({"share_easy": F.least(easy, F.lit(1.0)), "share_mixed": F.least(mixed, F.lit(1.0))})


def _clip(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(100.0))


def client_scores(base: DataFrame) -> DataFrame:
    """The eight component scores and the two purchase scores, rounded half to even."""
    cut = base.withColumn("cv_cut", F.least(F.col("cv"), F.lit(2.0)))
    x = minmax_score(cut, ["cv_cut", "entropy_color", "entropy_sku_finished", "entropy_analysis_key", "entropy_pack_key", "entropy_order_type"])
    part = lambda w, c: F.lit(float(w)) * F.coalesce(F.col(c), F.lit(0.0)) * 100
    low = lambda w, c: F.lit(float(w)) * F.col(f"minmax_{c}")
    scored = x.withColumns(
        {
            "score_frequency": _clip(F.col("active_share") * 100),
            "score_volume": F.col("minmax_cv_cut"),
            "score_color": _clip(part(0.45, "top3_color") + part(0.35, "similarity_color") + low(0.20, "entropy_color")),
            "score_sku": _clip(part(0.55, "top5_sku_finished") + part(0.30, "similarity_sku_finished") + low(0.15, "entropy_sku_finished")),
            "score_analysis": _clip(part(0.50, "top5_analysis") + part(0.35, "similarity_analysis_key") + low(0.15, "entropy_analysis_key")),
            "score_pack": _clip(part(0.70, "top3_pack") + low(0.30, "entropy_pack_key")),
            "score_type": _clip(part(0.55, "top1_order_type") + part(0.30, "similarity_order_type") + low(0.15, "entropy_order_type")),
            "score_miss": _clip((1 - F.col("fulfilment")) * 100),
            "score_ease": _clip(F.col("share_easy") * 100 - F.col("share_rainbow") * 40),
        }
    )
    weights = {"frequency": 0.14, "volume": 0.14, "color": 0.23, "analysis": 0.18, "pack": 0.08, "type": 0.08, "miss": 0.15}
    total = functools.reduce(lambda a, b: a + b, [F.lit(w) * F.col(f"score_{n}") for n, w in weights.items()])
    # As decimals, so that the order in which parts were added can't turn a tie.
    rounded = lambda x: F.bround(x.cast("decimal(18,8)"), 2).cast("double")
    rated = scored.withColumn("score_purchase", rounded(total))
    operative = rounded(F.lit(0.82) * F.col("score_purchase") + F.lit(0.18) * F.col("score_ease"))
    return rated.withColumn("score_operative", operative).drop("cv_cut", *[c for c in rated.columns if c.startswith("minmax_")])


def client_recommendation(score: Column) -> Column:
    return (
        F.when(score >= 80, "ALTA_PRIORIDAD_COMPRAR_TERMINADO")
        .when(score.between(65, 79.999), "PILOTO_SKUS_TOP")
        .when(score.between(50, 64.999), "COMPRAR_COLOR_O_BASE_VALIDAR")
        .otherwise("NO_ANTICIPAR_TERMINADO")
    )


def client_segment(frequency: Column, color: Column, sku: Column) -> Column:
    return (
        F.when((frequency >= 70) & (color >= 70) & (sku >= 65), "CONSTANTE_ESTRUCTURA_ESTABLE")
        .when((frequency >= 70) & (color < 70), "CONSTANTE_PERO_VARIABLE_COLOR_SKU")
        .when(frequency < 40, "OCASIONAL")
        .otherwise("INTERMEDIO")
    )


#: What a profile is made of.
PROFILE_USED = {*CLIENT, "order_date", "year_week", "stems", "stems_confirmed", "shortfall", "product", "variety", *SIMILARITIES, *ENTROPIES, *[c for c, _, _ in TOP_SHARES]}


def client_profile(df: DataFrame) -> DataFrame:
    """One row per client. Every part is grouped by client first, so the joins meet one row per client.

    The narrow projection of the lines is written once, as six figures are made of it."""
    df = stored_once(df, PROFILE_USED, "profile-lines")
    parts = [client_volume_stats(df), client_recency(df), client_top_share(df), client_entropy(df), weekly_mix_similarity(df), client_type_shares(df)]
    scored = client_scores(functools.reduce(lambda a, b: a.join(b, CLIENT), parts))
    return scored.withColumns(
        {
            "recommendation": client_recommendation(F.col("score_purchase")),
            "client_segment": client_segment(F.col("score_frequency"), F.col("score_color"), F.col("score_sku")),
        }
    )


def filter_profiles(profile: DataFrame, recommendations: list[str] | None = None, segments: list[str] | None = None, least_score: float | None = None, active_only: bool = False) -> DataFrame:
    out = profile
    if recommendations:
        out = out.where(F.col("recommendation").isin(recommendations))
    if segments:
        out = out.where(F.col("client_segment").isin(segments))
    if least_score is not None:
        out = out.where(F.col("score_purchase") >= least_score)
    return out.where("active_16w") if active_only else out


def segment_overview(profile: DataFrame) -> DataFrame:
    return profile.groupBy("client_segment").agg(
        F.count(F.lit(1)).alias("clients"), F.sum("stems").alias("stems"), F.avg("score_purchase").alias("mean_score")
    )
