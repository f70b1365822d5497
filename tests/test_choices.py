"""Choices and scores against plain versions on hand-made frames."""

import math

import numpy as np
from pyspark.ml.linalg import Vectors

from bloomline.operators import clustering, profile, weekly


def test_every_cluster_of_one_counts():
    assert clustering.selection_score(0.5, [6, 1, 1], 8) == 0.5 - 2 * 0.18
    assert math.isclose(clustering.selection_score(0.5, [9, 1], 10), 0.5 - 0.18 - 0.12 * 0.5)
    assert clustering.selection_score(None, [4, 4], 8) == -1.0
    first = ("ward", 2, None, 0.5, [4, 4], 3.0)
    assert clustering.cluster_selection([first, ("kmeans", 3, None, 0.6, [6, 1, 1], 9.0)], 8) == first
    assert clustering.cluster_selection([first, ("kmeans", 2, None, 0.5, [4, 4], 3.0)], 8)[0] == "kmeans"
    assert clustering.cluster_selection([("kmodes", 2, None, None, [4, 4], 9.0), first], 8) == first
    assert clustering.cluster_selection([], 8) is None


def test_calinski_harabasz(spark):
    rng = np.random.default_rng(1)
    x, cluster = rng.normal(size=(30, 4)), np.arange(30) % 3
    x += cluster[:, None]
    found = spark.createDataFrame([(int(c), Vectors.dense(v)) for c, v in zip(cluster, x, strict=True)], ["cluster", "x"])
    centres = np.stack([x[cluster == c].mean(0) for c in range(3)])
    within = ((x - centres[cluster]) ** 2).sum()
    between = (10 * (centres - x.mean(0)) ** 2).sum()
    assert math.isclose(clustering.calinski_harabasz(found, 30), between / 2 / (within / 27))


def lines(spark, rows):
    return spark.createDataFrame([("c", "client", *r) for r in rows], "client_code string, client string, year_week string, color string, stems double")


def test_entropy_share_and_week_similarity(spark):
    df = lines(spark, [("1", "red", 3.0), ("1", "blue", 1.0), ("2", "red", 3.0), ("4", "blue", 2.0), ("4", None, 1.0)])
    p = np.array([6, 3, 1]) / 10
    assert math.isclose(profile.entropies(df, ["color"]).first().entropy_color, -(p * np.log(p)).sum() / np.log(3))
    assert math.isclose(profile.top_share(df, "color", 1, "top").first().top, 0.6)
    row = profile.week_similarities(df, ["color"]).first()
    one = 3 / math.sqrt(10)
    assert math.isclose(row.similarity_color, one / 2) and row.similarity_min_color == 0.0
    assert profile.week_similarities(lines(spark, [("1", "red", 3.0)]), ["color"]).first().similarity_color == 0.0


def test_forecast_metrics(spark):
    df = spark.createDataFrame([(10.0, 8.0), (0.0, 1.0), (20.0, 26.0)], "stems double, m double")
    r = weekly.forecast_metrics(df, ["m"]).first()
    assert math.isclose(r.mae, 3) and math.isclose(r.wape, 9 / 30) and math.isclose(r.bias, 5 / 30)
    assert math.isclose(r.mape_nonzero, (0.2 + 0.3) / 2) and math.isclose(r.rmse, math.sqrt((4 + 1 + 36) / 3))
