"""A planted driver comes first, an unused feature is worth nothing, and a permutation keeps every row."""

import random

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from bloomline.operators import importance, weekly


def target(spark, n=600):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        x = {c: rng.random() * 10 for c in weekly.FEATURES}
        x["growth"] = 1.0  # the same everywhere: unused
        bought = x["activity_8"] > 5
        market = "m1" if i % 3 else "m2"
        rows.append((f"c{i}", market, "x", "rose", "red", "2024-01-01", float(np.expm1(x["lag_1"] / 2)) + 1 if bought else 0.0, *x.values()))
    names = "client string, market string, country string, product string, color string, week_start string, stems double"
    return spark.createDataFrame(rows, names + "".join(f", {c} double" for c in weekly.FEATURES))


def test_planted_drivers_come_first(spark):
    df = target(spark)
    known = weekly.vectors(df).select("x", (F.col("stems") > 0).cast("double").alias("bought"), F.log1p("stems").alias("y"))
    fitted = weekly.TwoStage(
        GBTClassifier(featuresCol="x", labelCol="bought", maxIter=4, maxDepth=3, seed=1).fit(known),
        GBTRegressor(featuresCol="x", labelCol="y", maxIter=4, maxDepth=3, seed=1).fit(known.where("bought = 1")),
        1.0,
    )
    got = importance.permutation_importance(fitted, df, sample=150).cache()
    assert got.count() == 2 * 3 * len(weekly.FEATURES)
    of = {(r.stage, r.market, r.variable): r for r in got.collect()}
    for market in ("m1", "m2", importance.ALL):
        for stage, driver in ((importance.OCCURRENCE, "activity_8"), (importance.VOLUME, "lag_1")):
            mine = [v for (s, m, _), v in of.items() if (s, m) == (stage, market)]
            assert max(mine, key=lambda v: v.importance).variable == driver
            assert of[stage, market, "growth"].importance == of[stage, market, "growth"].spread == 0
    assert of[importance.OCCURRENCE, importance.ALL, "lag_1"].rows == 150
    top = importance.forecast_top_drivers(got, 1, 1).collect()
    assert {(r.stage, r.variable) for r in top} == {(importance.OCCURRENCE, "activity_8"), (importance.VOLUME, "lag_1")} and len(top) == 6


def test_a_permutation_uses_every_row_once(spark):
    rows = spark.createDataFrame([("g", f"n{i}", [float(i)]) for i in range(50)], "grp string, name string, x array<double>")
    chosen = importance.bounded_sample(rows, 40, 1)
    got = importance.shuffled(chosen, 2, 1).collect()
    assert len(got) == 40
    for r in range(2):
        assert sorted(v.others[r][0] for v in got) == sorted(v.x[0] for v in got) and any(v.others[r] != v.x for v in got)


def test_small_markets_have_no_importance(spark):
    df = target(spark, 15)
    known = weekly.vectors(df).select("x", (F.col("stems") > 0).cast("double").alias("y"))
    fitted = weekly.TwoStage(GBTClassifier(featuresCol="x", labelCol="y", maxIter=1).fit(known), GBTRegressor(featuresCol="x", labelCol="y", maxIter=1).fit(known), 1.0)
    assert {r.market for r in importance.permutation_importance(fitted, df).collect()} == {importance.ALL}
