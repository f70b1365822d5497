"""Clusters of clients within each market: features, weighted z-scores, a choice among three methods and numbers of clusters, names, and
what tells the clusters apart."""

from __future__ import annotations

import functools

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bloomline.functions.text import ratio
from bloomline.operators.cleaning import classify_market
from bloomline.operators.partitions import cluster_kmodes, cluster_ward
from bloomline.operators.profile import CLIENT, client_type_shares, entropies, top_shares
from bloomline.operators.selecting import rank_buckets, tie_breaker
from bloomline.operators.similarity import client_share_matrix
from bloomline.operators.structures import since
from bloomline.sources.tables import stored, stored_once

# Weights of the feature blocks.
BLOCKS = {
    "active_weeks": 1.6, "cv": 1.6, "top3_color": 2.4, "entropy_color": 2.4, "top3_product": 2.0, "entropy_product": 2.0,
    "share_solido": 1.7, "share_surtido": 1.7, "share_rainbow": 1.7, "share_bulk": 1.7, "skus": 0.8, "stems": 0.8, "fulfilment": 0.5,
}
SINGLETON_PENALTY, DOMINANCE_PENALTY = 0.18, 0.12
# The block of each feature.
BLOCK_OF = {
    "active_weeks": "constancia", "cv": "constancia", "top3_color": "color", "entropy_color": "color", "top3_product": "producto",
    "entropy_product": "producto", "share_solido": "tipo_pedido", "share_surtido": "tipo_pedido", "share_rainbow": "tipo_pedido",
    "share_bulk": "tipo_pedido", "skus": "sku", "stems": "volumen", "fulfilment": "cumplimiento",
}
#: Categories that k-modes compares.
DOMINANT = ["main_country", "dominant_product", "dominant_color", "dominant_type", "dominant_box"]
PREFERENCE = {"kmeans": 3, "ward": 2, "kmodes": 1}


FEATURES_USED = {*CLIENT, "order_date", "year_week", "country", "color", "product", "order_type", "box_type", "sku_finished", "stems", "stems_confirmed", "sales_usd"}


def cluster_features(df: DataFrame) -> DataFrame:
    """Per client: market, volume, recent change, concentration, variety, type shares and dominant values. The narrow lines are written once,
    as five parts are made of them."""
    df = stored_once(df, FEATURES_USED, "feature-lines")
    placed = since(df, {"now": 8, "before": 16}).withColumn("market", classify_market(F.col("country")))
    recent = F.sum(F.when(F.col("now"), F.col("stems")).otherwise(0.0))
    earlier = F.sum(F.when(F.col("before") & ~F.col("now"), F.col("stems")).otherwise(0.0))
    base = placed.groupBy(*CLIENT).agg(
        F.mode("market", True).alias("market"),
        F.sum("stems").alias("stems"),
        ratio(F.sum("sales_usd"), F.sum("stems")).alias("usd_per_stem"),
        F.count_distinct("year_week").alias("active_weeks"),
        F.count_distinct("color").alias("colors"),
        F.count_distinct("product").alias("products"),
        F.count_distinct("sku_finished").alias("skus"),
        F.mode("color", True).alias("dominant_color"),
        F.mode("product", True).alias("dominant_product"),
        F.mode("order_type", True).alias("dominant_type"),
        F.mode("country", True).alias("main_country"),
        F.mode("box_type", True).alias("dominant_box"),
        ratio(F.sum("stems_confirmed"), F.sum("stems")).alias("fulfilment"),
        recent.alias("recent_stems"),
        F.try_divide(recent - earlier, earlier).alias("recent_change"),
    )
    weekly = df.groupBy(*CLIENT, "year_week").agg(F.sum("stems").alias("s"))
    spread = weekly.groupBy(*CLIENT).agg(ratio(F.coalesce(F.stddev_samp("s"), F.lit(0.0)), F.avg("s")).alias("cv"))
    parts = [base, spread, top_shares(df, [("color", 3, "top3_color"), ("product", 3, "top3_product")]), entropies(df, ["color", "product"]), client_type_shares(df)]
    joined = functools.reduce(lambda a, b: a.join(b, CLIENT), parts)
    whole = joined.groupBy("market").agg(F.sum("stems").alias("market_stems"))  # five rows
    return joined.join(F.broadcast(whole), "market").withColumn("market_share", ratio(F.col("stems"), F.col("market_stems"))).drop("market_stems")


def weighted_matrix(features: DataFrame) -> DataFrame:
    """features with z_<column>: population z-score within the market (0 where all are equal) times the root of the weight."""
    x = lambda c: F.col(c).cast("double")
    figures = [f(x(c)).alias(f"{n}_{c}") for c in BLOCKS for n, f in (("mean", F.avg), ("sd", F.stddev_pop))]
    market = features.groupBy("market").agg(*figures)  # five rows
    joined = features.join(F.broadcast(market), "market")
    z = {f"z_{c}": F.coalesce(F.try_divide(x(c) - F.col(f"mean_{c}"), F.col(f"sd_{c}")), F.lit(0.0)) * F.sqrt(F.lit(w)) for c, w in BLOCKS.items()}
    return joined.withColumns(z).select(*features.columns, *z)


def vectors(matrix: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"z_{c}" for c in BLOCKS], outputCol="x").transform(matrix)


def calinski_harabasz(found: DataFrame, size: int) -> float:
    """Between-cluster over within-cluster squared distances of x, each by its degrees of freedom; 0 where undefined.

    One pass: with n, the sum and the squared length of each cluster's vectors, both follow."""
    place = F.posexplode(vector_to_array("x"))
    long = found.select("cluster", place.alias("place", "v"))
    per = long.groupBy("cluster", "place").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"), F.count(F.lit(1)).alias("n"))
    rows = per.collect()  # clusters x features
    k, places = len({r.cluster for r in rows}), {r.place for r in rows}
    within = sum(r.q - r.s * r.s / r.n for r in rows)
    total = sum(sum(r.q for r in rows if r.place == p) - sum(r.s for r in rows if r.place == p) ** 2 / size for p in places)
    return float((total - within) / (k - 1) / (within / (size - k))) if within > 0 and 1 < k < size else 0.0


def dummies(rows: DataFrame) -> DataFrame:
    """rows with h: the categories of DOMINANT as one sparse vector of zeros and ones."""
    index = StringIndexer(inputCols=DOMINANT, outputCols=[f"i_{c}" for c in DOMINANT], stringOrderType="alphabetAsc", handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"i_{c}" for c in DOMINANT], outputCols=[f"o_{c}" for c in DOMINANT], dropLast=False)
    vector = VectorAssembler(inputCols=[f"o_{c}" for c in DOMINANT], outputCol="h")
    return Pipeline(stages=[index, hot, vector]).fit(rows).transform(rows).drop(*[f"{p}_{c}" for p in "io" for c in DOMINANT])


def silhouette(found: DataFrame, sizes: list[int], n: int) -> float | None:
    """Mean silhouette of x by squared distances; none for fewer than four rows, one cluster, or as many clusters as rows."""
    if n < 4 or not 2 <= len(sizes) < n:
        return None
    return float(ClusteringEvaluator(featuresCol="x", predictionCol="cluster").evaluate(found))


def label_of(k: int):
    return F.filter("labels", lambda one: one.k == k)[0].cluster


def candidate_clusters(matrix: DataFrame, market: str, modes: DataFrame, most: int = 6, seed: int = 42) -> list[tuple]:
    """(method, k, assignments, silhouette, sizes, calinski) of a market's candidates: k-means and Ward's merging of the weighted figures,
    k-modes of the dominant values (modes, whose own figures are of its categories as zeros and ones).

    Merging and modes give all numbers of clusters at once; each candidate is then judged in two passes over one market's clients."""
    rows = stored(dummies(vectors(matrix.where(F.col("market") == market))).select(*CLIENT, "market", "x", "h"), "cluster-rows")
    n, out = rows.count(), []
    ks = range(2, min(most, n - 1) + 1)
    merged = stored(cluster_ward(rows, ks, CLIENT, seed=seed), "cluster-ward")
    moded = stored(rows.drop("x").withColumnRenamed("h", "x").join(modes.drop("market"), CLIENT), "cluster-modes")
    for k in ks:
        means = KMeans(featuresCol="x", predictionCol="cluster", k=k, seed=seed).fit(rows).transform(rows)
        for method, found in (("kmeans", means), ("ward", merged.withColumn("cluster", label_of(k))), ("kmodes", moded.withColumn("cluster", label_of(k)))):
            found = stored(found.select(*CLIENT, "market", "x", "cluster"), "cluster-found")
            sizes = [r.n for r in found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()]  # k rows
            out.append((method, k, found, silhouette(found, sizes, n), sizes, calinski_harabasz(found, n)))
    return out


def selection_score(silhouette: float | None, sizes: list[int], n: int) -> float:
    """Silhouette (-1 without one) less a penalty for each cluster of one client and for a cluster of more than 80 % of them."""
    dominance = max(0.0, max(sizes) / n - 0.8) / 0.2
    return (-1.0 if silhouette is None else silhouette) - SINGLETON_PENALTY * sum(s == 1 for s in sizes) - DOMINANCE_PENALTY * dominance


def cluster_selection(candidates: list, n: int) -> tuple | None:
    """The candidate of the highest score; of equal ones that of the higher silhouette, then Calinski-Harabasz index, then k-means before
    Ward before k-modes, then the fewest clusters."""
    low = lambda v: -999.0 if v is None else v
    return max(candidates, key=lambda c: (selection_score(c[3], c[4], n), low(c[3]), low(c[5]), PREFERENCE.get(c[0], 0), -c[1]), default=None)


def cluster_assignments(features: DataFrame, least_clients: int = 4, most: int = 6) -> DataFrame:
    """Per client its market's chosen cluster; markets with few clients stay one cluster. Fits while the plan is made."""
    matrix = stored(weighted_matrix(features), "cluster-matrix")
    sizes = {r.market: r.n for r in matrix.groupBy("market").agg(F.count(F.lit(1)).alias("n")).collect()}  # five markets
    enough = matrix.where(F.col("market").isin([m for m, n in sizes.items() if n >= least_clients]))
    modes = stored(cluster_kmodes(enough, DOMINANT, range(2, most + 1), CLIENT), "cluster-kmodes")
    out = None
    for market, n in sorted(sizes.items()):
        chosen = cluster_selection(candidate_clusters(matrix, market, modes, most), n) if n >= least_clients else None
        if chosen:
            label = F.concat(F.lit(f"{market}_C"), F.lpad((F.col("cluster") + 1).cast("string"), 2, "0"))
            figures = {"method": chosen[0], "k": chosen[1], "silhouette": chosen[3], "calinski": chosen[5]}
            part = chosen[2].select(*CLIENT, "market", label.alias("cluster_id"), *[F.lit(v).alias(c) for c, v in figures.items()])
        else:
            none = [F.lit("none").alias("method"), F.lit(1).alias("k"), *[F.lit(None).cast("double").alias(c) for c in ("silhouette", "calinski")]]
            part = matrix.where(F.col("market") == market).select(*CLIENT, "market", F.lit(f"{market}_SIN_CLUSTER").alias("cluster_id"), *none)
        out = part if out is None else out.unionByName(part)
    return out


def cluster_names(assigned: DataFrame, profile: DataFrame) -> DataFrame:
    """Per cluster its clients and its name, from the means of their profiles (fixed values: names and thresholds)."""
    per = assigned.select(*CLIENT, "market", "cluster_id").join(profile, CLIENT, "left").groupBy("market", "cluster_id").agg(
        F.count(F.lit(1)).alias("clients"), *[F.avg(F.coalesce(c, F.lit(0.0))).alias(c) for c in ("top5_sku_finished", "top3_color", "active_share", "cv")],
        F.sum("stems").alias("stems"), F.avg("score_operative").alias("score"),
    )
    sku, color, weeks, cv, score = (F.coalesce(c, F.lit(0.0)) for c in ("top5_sku_finished", "top3_color", "active_share", "cv", "score"))
    one = (
        F.when(F.col("stems") >= 1_000_000, "ATIPICO_ALTO_VOLUMEN").when((sku >= 0.9) | (color >= 0.9), "NICHO_ESPECIALIZADO")
        .otherwise("ATIPICO_BAJA_BASE")
    )
    many = (
        F.when((score >= 75) & (weeks >= 0.55) & (cv <= 0.8), "CONSTANTES_ESTRUCTURA_ESTABLE")
        .when((sku >= 0.75) & (color >= 0.75), "ESPECIALISTAS_SKU_COLOR")
        .when((weeks >= 0.45) & (cv <= 1.2), "RECURRENTES_VOLUMEN_MEDIO")
        .when(score >= 60, "PILOTO_COMPRA_TERMINADA")
        .otherwise("VARIABLES_O_BAJA_RECURRENCIA")
    )
    few = F.when(sku >= 0.9, "NICHO_ESPECIALIZADO").otherwise("GRUPO_PEQUENO_ATIPICO")
    name = F.when(F.col("clients") == 1, one).when(F.col("clients") <= 3, few).otherwise(many)
    return per.select("market", "cluster_id", "clients", name.alias("cluster_name"))


def cluster_block_profile(features: DataFrame, assigned: DataFrame, k: int = 10) -> DataFrame:
    """Per cluster its clients and dominant values, the mean importance of each block among its k most telling features (0 where none of them
    is of the block), the block that tells most (the first by name of equal ones), and that block's three most telling features."""
    keys = ["market", "cluster_id"]
    told = cluster_differences(features, assigned, k).withColumns(
        {"feature": F.substring("feature", 3, 100), "importance": F.abs("delta")}
    )
    block = F.create_map(*[F.lit(v) for item in BLOCK_OF.items() for v in item])[F.col("feature")]
    told = told.withColumn("block", block)
    listed = F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("i"), "feature"))), 1, 3), lambda x: x.feature)
    per = told.groupBy(*keys, "block").agg(F.avg("importance").alias("importance"), F.array_join(listed, "; ").alias("key_features"))
    names = sorted(set(BLOCK_OF.values()))
    # One aggregate instead of a pivot and a join: the blocks' columns and the first of them by importance.
    wide = per.groupBy(*keys).agg(
        *[F.coalesce(F.max(F.when(F.col("block") == b, F.col("importance"))), F.lit(0.0)).alias(b) for b in names],
        F.min(F.struct((-F.col("importance")).alias("i"), "block", "key_features")).alias("top"),
    )
    base = features.join(assigned.select(*CLIENT, "cluster_id"), CLIENT).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("clients"), *[F.mode(c, True).alias(c) for c in ("dominant_type", "dominant_product", "dominant_color")]
    )
    out = base.join(wide, keys, "left")
    return out.select(*base.columns, *names, F.col("top.block").alias("top_block"), F.col("top.key_features").alias("top_features"))


#: Figures of the profile that the simple clusters use beside the mix.
SIMPLE = ["active_share", "cv", "fulfilment", "top3_color", "top5_sku_finished", "top3_pack", "score_purchase"]


def simple_name(score):
    """Name of a cluster by its mean score."""
    return (
        F.when(score >= 75, "CLIENTES_ESTABLES_PARA_TERMINADO").when(score >= 60, "CLIENTES_PILOTO")
        .when(score >= 45, "CLIENTES_COMPRA_COLOR_BASE").otherwise("CLIENTES_VARIABLES_NO_ANTICIPAR")
    )


def cluster_simple(df: DataFrame, profile: DataFrame, k: int = 5, by: str = "kmeans", items: int = 100, seed: int = 42) -> DataFrame:
    """All clients in k clusters: k-means of scaled profile figures beside the scaled shares of the largest items, or (by="rank") buckets of the
    ranked purchase score. A cluster is named by its mean score; a single client has none."""
    mix = client_share_matrix(df, "product_color", items)
    clients = mix.select(*CLIENT).distinct()
    figures = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in SIMPLE]
    rows = stored(clients.join(profile, CLIENT, "left").select(*CLIENT, *figures), "simple-rows")
    n = rows.count()
    if n < 2:
        return rows.select(*CLIENT, F.lit(0).alias("cluster_id"), "score_purchase", F.lit("SIN_CLUSTER").alias("cluster_name"))
    k = min(max(2, k), n)
    if by == "rank":
        placed = rows.withColumn("cluster_id", rank_buckets(rows, F.col("score_purchase"), tie_breaker(*CLIENT), k))
    else:
        # At most `items` values are numbered; clients get one sparse vector of their shares.
        names = [r.item for r in mix.select("item").distinct().orderBy("item").collect()]
        share = lambda name: F.coalesce(F.max(F.when(F.col("item") == name, F.col("share"))), F.lit(0.0))
        shares = mix.groupBy(*CLIENT).agg(*[share(name).alias(f"s{i}") for i, name in enumerate(names)])
        inputs = [*SIMPLE, *[f"s{i}" for i in range(len(names))]]
        wide = VectorAssembler(inputCols=inputs, outputCol="raw").transform(rows.join(shares, CLIENT))
        wide = stored(wide.select(*CLIENT, "score_purchase", "raw"), "simple-wide")
        scaled = StandardScaler(inputCol="raw", outputCol="x", withMean=True).fit(wide).transform(wide)
        placed = KMeans(featuresCol="x", predictionCol="cluster_id", k=k, seed=seed).fit(scaled).transform(scaled)
    placed = placed.select(*CLIENT, "cluster_id", "score_purchase")
    named = placed.groupBy("cluster_id").agg(simple_name(F.avg("score_purchase")).alias("cluster_name"))  # k rows
    return placed.join(F.broadcast(named), "cluster_id")


def cluster_summary(features: DataFrame, assigned: DataFrame) -> DataFrame:
    return features.join(assigned.select(*CLIENT, "cluster_id"), CLIENT).groupBy("market", "cluster_id").agg(
        F.count(F.lit(1)).alias("clients"), F.sum("stems").alias("stems"), F.avg("active_weeks").alias("mean_weeks"), F.avg("cv").alias("mean_cv"),
        F.mode("dominant_color", True).alias("dominant_color"), F.mode("dominant_product", True).alias("dominant_product"), F.mode("dominant_type", True).alias("dominant_type"),
    )


def cluster_differences(features: DataFrame, assigned: DataFrame, k: int = 12) -> DataFrame:
    """Per cluster the features that differ most from the market, by the size of the mean weighted z-score."""
    z = [f"z_{c}" for c in BLOCKS]
    matrix = weighted_matrix(features).join(assigned.select(*CLIENT, "cluster_id"), CLIENT)
    long = matrix.unpivot(["market", "cluster_id"], z, "feature", "z")
    per = long.groupBy("market", "cluster_id", "feature").agg(F.avg("z").alias("delta"))
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc(F.abs("delta")), "feature"))
    return per.withColumn("place", place).where(F.col("place") <= k)


def cluster_representatives(features: DataFrame, assigned: DataFrame, k: int = 5) -> DataFrame:
    joined = features.join(assigned.select(*CLIENT, "cluster_id"), CLIENT).select("cluster_id", *CLIENT, "stems")
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("stems"), *CLIENT))
    return joined.withColumn("place", place).where(F.col("place") <= k)
