"""Two ways of clustering that Spark ML lacks: k-modes of categories, and Ward's merging over a bounded number of micro-clusters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomline.sources.tables import stored

#: Micro-clusters that Ward's merging starts from; with no more rows than this it is exact.
MICRO = 1_000


def seed_rows(rows: DataFrame, columns: list[str], group: str, keys: list[str], n: int, seed: int) -> dict[str, list[list[str]]]:
    """Per group the categories of the n rows with the smallest hashes of seed and key (groups are few, each is one bounded top-n)."""
    out = {}
    for g in sorted(r[group] for r in rows.select(group).distinct().collect()):
        order = F.xxhash64(F.lit(seed), *keys)
        out[g] = [list(r) for r in rows.where(F.col(group) == g).orderBy(order, *keys).limit(n).select(*columns).collect()]
    return out


def cluster_kmodes(rows: DataFrame, columns: list[str], ks: Sequence[int], keys: list[str], group: str = "market", seed: int = 42, rounds: int = 25) -> DataFrame:
    """rows (keys, group and text columns) as keys, group and labels: an array of (k, cluster), for every k of ks at once.

    A row goes to the mode it differs from in the fewest columns (the first of equal ones), a mode takes each column's commonest value (the
    smallest of equally common ones), until nothing changes. Each round is one aggregate over all groups and ks; the modes are a broadcast
    of groups x sum(ks) rows. Nulls are sin_info. A cluster that loses all its rows starts again from the next seed row."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("sin_info")).alias(c) for c in columns]
    rows = stored(rows.select(*keys, group, *values), "kmodes-rows")
    spark, most = rows.sparkSession, max(ks)
    seeds = seed_rows(rows, columns, group, keys, 2 * most, seed)
    modes = {(g, k): [some[c % len(some)] for c in range(k)] for g, some in seeds.items() for k in ks}
    used = {g: most for g in seeds}

    def labelled() -> DataFrame:
        table = [(g, [(k, modes[g, k]) for k in ks]) for g in seeds]
        shared = spark.createDataFrame(table, f"{group} string, choices array<struct<k: int, modes: array<array<string>>>>")
        given = F.array(*columns)

        def apart(mode):
            return F.aggregate(F.zip_with(given, mode, lambda a, b: (a != b).cast("int")), F.lit(0), lambda x, y: x + y)

        def label(choice):
            far = F.transform(choice.modes, lambda mode, place: F.struct(apart(mode).alias("d"), place.alias("c")))
            return F.struct(choice.k.alias("k"), F.array_min(far).c.alias("cluster"))

        return rows.join(F.broadcast(shared), group).select(*keys, group, *columns, F.transform("choices", label).alias("labels"))

    for _ in range(rounds):
        long = labelled().select(group, F.explode("labels").alias("l"), F.array(*columns).alias("v"))
        counted = long.select(group, "l.k", "l.cluster", F.posexplode("v").alias("place", "value"))
        counted = counted.groupBy(group, "k", "cluster", "place", "value").agg(F.count(F.lit(1)).alias("n"))
        common = counted.groupBy(group, "k", "cluster", "place").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("x"))
        found = {(r[group], r.k, r.cluster, r.place): r.x.value for r in common.collect()}
        after = {}
        for (g, k), own in modes.items():
            after[g, k] = []
            for c in range(k):
                if (g, k, c, 0) in found:
                    after[g, k].append([found[g, k, c, p] for p in range(len(columns))])
                else:
                    after[g, k].append(seeds[g][used[g] % len(seeds[g])])
                    used[g] += 1
        if after == modes:
            break
        modes = after
    return labelled().select(*keys, group, "labels")


def ward_labels(sizes: np.ndarray, centres: np.ndarray, ks: Sequence[int]) -> dict[int, np.ndarray]:
    """Labels of weighted points for each number of clusters, merged by the least growth of the squared distances within (Lance-Williams);
    of equal merges the first pair. Labels count from 0 in the order of the clusters' first points."""
    m = len(sizes)
    n = sizes.astype(float).copy()
    square = (centres * centres).sum(1)
    d = np.maximum(square[:, None] + square[None] - 2 * centres @ centres.T, 0) * (n[:, None] * n[None] / (n[:, None] + n[None]))
    np.fill_diagonal(d, np.inf)
    own, alive, out = np.arange(m), np.ones(m, bool), {}
    for left in range(m, 0, -1):
        if left in ks:
            out[left] = np.unique(own, return_inverse=True)[1]
        if left == 1:
            break
        i, j = divmod(int(d.argmin()), m)
        i, j = min(i, j), max(i, j)
        rest = alive.copy()
        rest[[i, j]] = False
        grown = ((n[i] + n[rest]) * d[i, rest] + (n[j] + n[rest]) * d[j, rest] - n[rest] * d[i, j]) / (n[i] + n[j] + n[rest])
        d[i, rest] = d[rest, i] = grown
        d[j], d[:, j] = np.inf, np.inf
        n[i], alive[j] = n[i] + n[j], False
        own[own == j] = i
    return out


def cluster_ward(rows: DataFrame, ks: Sequence[int], keys: list[str], micro: int = MICRO, seed: int = 42) -> DataFrame:
    """rows (keys and a vector x) with labels: an array of (k, cluster). With at most micro rows this is Ward's merging of all of them;
    with more, of the sums of so many micro-clusters, which k-means makes in two passes, so nothing larger goes to the driver."""
    n = rows.count()
    if n <= micro:
        placed = rows.withColumn("micro", F.xxhash64(*keys))
    else:
        placed = KMeans(featuresCol="x", predictionCol="micro", k=micro, maxIter=2, initMode="random", seed=seed).fit(rows).transform(rows)
    placed = stored(placed, "ward-rows")
    sums = placed.groupBy("micro").agg(F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(F.col("x"))).alias("mean"), F.min(F.struct(*keys)).alias("first"))
    found = sorted(sums.collect(), key=lambda r: tuple(r["first"]))  # at most `micro` rows
    ks = [k for k in ks if k <= len(found)]
    labels = ward_labels(np.array([r.n for r in found]), np.array([r["mean"] for r in found]), ks) if found else {}
    table = [(r.micro, [(k, int(labels[k][i])) for k in ks]) for i, r in enumerate(found)]
    kind = placed.schema["micro"].dataType.simpleString()
    shared = rows.sparkSession.createDataFrame(table, f"micro {kind}, labels array<struct<k: int, cluster: int>>")
    return placed.join(F.broadcast(shared), "micro").drop("micro")
