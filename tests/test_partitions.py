"""k-modes and Ward's merging against plain numpy versions, the choice among all methods on planted markets, and simple clusters."""

from itertools import count

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from bloomline.operators import clustering
from bloomline.operators.partitions import cluster_kmodes, cluster_ward, seed_rows, ward_labels

COLUMNS = ["a", "b", "c"]


def plain_kmodes(values, seeds, k, spare, rounds=25):
    modes = [list(seeds[c % len(seeds)]) for c in range(k)]
    for _ in range(rounds):
        labels = [min(range(k), key=lambda c: (sum(x != y for x, y in zip(row, modes[c], strict=True)), c)) for row in values]
        after = []
        for c in range(k):
            own = [row for row, label in zip(values, labels, strict=True) if label == c]
            if own:
                after.append([min(set(col), key=lambda v: (-col.count(v), v)) for col in (list(x) for x in zip(*own, strict=True))])
            else:
                after.append(list(next(spare)))
        if after == modes:
            return labels
        modes = after
    return labels


def test_kmodes_equals_a_plain_version(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in ("x", "y"):
        for i in range(60):
            base = ["p", "q", "r"] if i % 3 else ["s", "q", "t"]
            rows.append((g, i, *[v if rng.random() < 0.75 else rng.choice(list("pqrstu")) for v in base]))
    df = spark.createDataFrame([(g, i, *map(str, v)) for g, i, *v in rows], "market string, id int, a string, b string, c string").repartition(3)
    df = df.withColumn("b", F.when(F.col("id") == 7, None).otherwise(F.col("b")))
    filled = df.fillna("sin_info", COLUMNS)
    for k in (2, 4):
        got = {(r.market, r.id): r.labels[0].cluster for r in cluster_kmodes(df, COLUMNS, [k], ["id"]).collect()}
        seeds = seed_rows(filled, COLUMNS, "market", ["id"], 2 * k, 42)
        for g in ("x", "y"):
            values = filled.where(F.col("market") == g).orderBy("id").select(*COLUMNS).collect()
            spare = (seeds[g][i % len(seeds[g])] for i in count(k))
            want = plain_kmodes([list(v) for v in values], seeds[g], k, spare)
            assert [got[g, i] for i in range(60)] == want
    both = cluster_kmodes(df, COLUMNS, [2, 3], ["id"]).first()
    assert [one.k for one in both.labels] == [2, 3]


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = min(
            (len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum(), i, j)
            for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j
        )
        _, i, j = best
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


def test_ward_equals_merging_by_definition():
    x = np.random.default_rng(3).normal(size=(40, 3))
    x[20:] += 4
    labels = ward_labels(np.ones(40), x, [1, 2, 3, 5, 40])
    for k in (1, 2, 3, 5, 40):
        found = {frozenset(np.flatnonzero(labels[k] == c).tolist()) for c in set(labels[k].tolist())}
        assert found == plain_ward(x, k)


@pytest.mark.parametrize("micro", [1000, 20])
def test_ward_of_rows(spark, micro):
    x = np.random.default_rng(4).normal(size=(90, 2)) * 0.2 + np.repeat([[0, 0], [5, 0], [0, 5]], 30, axis=0)
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "x"]).repartition(3)
    got = {r.id: {one.k: one.cluster for one in r.labels} for r in cluster_ward(df, [2, 3], ["id"], micro=micro).collect()}
    assert len({got[i][3] for i in range(30)}) == len({got[i][3] for i in range(30, 60)}) == 1 and len({v[3] for v in got.values()}) == 3
    assert len({v[2] for v in got.values()}) == 2


def features(spark):
    """Two markets of planted kinds of clients, one with too few."""
    rng = np.random.default_rng(6)
    rows = []
    for market, n in (("m1", 24), ("m2", 12), ("m3", 2)):
        for i in range(n):
            kind = i % 2
            figures = {c: float(kind * 3 + rng.normal() * 0.1) for c in clustering.BLOCKS}
            words = [f"{c}{kind}" for c in clustering.DOMINANT]
            rows.append((f"{market}-{i}", "client", market, *figures.values(), *words))
    names = ", ".join(f"{c} double" for c in clustering.BLOCKS) + ", " + ", ".join(f"{c} string" for c in clustering.DOMINANT)
    return spark.createDataFrame(rows, f"client_code string, client string, market string, {names}")


def test_the_chosen_clusters_are_the_planted_ones(spark):
    got = {r.client_code: r for r in clustering.cluster_assignments(features(spark), most=3).collect()}
    assert len(got) == 38 and {r.method for r in got.values()} <= {"kmeans", "ward", "kmodes", "none"}
    for market, n in (("m1", 24), ("m2", 12)):
        parts = [{got[f"{market}-{i}"].cluster_id for i in range(k, n, 2)} for k in (0, 1)]
        assert [len(p) for p in parts] == [1, 1] and parts[0] != parts[1]
    assert {got[f"m3-{i}"].cluster_id for i in range(2)} == {"m3_SIN_CLUSTER"} and got["m3-0"].silhouette is None


def test_silhouette_is_none_where_it_says_nothing(spark):
    df = spark.createDataFrame([(0, Vectors.dense([0.0])), (1, Vectors.dense([1.0])), (1, Vectors.dense([1.5]))], ["cluster", "x"])
    assert clustering.silhouette(df, [1, 2], 3) is None and clustering.silhouette(df, [3], 5) is None and clustering.silhouette(df, [1] * 5, 5) is None


def test_simple_clusters(spark):
    rng = np.random.default_rng(2)
    lines, scores = [], []
    for i in range(40):
        kind = i % 2
        lines += [(f"c{i}", "x", f"{color}{kind}", 10.0 + rng.random()) for color in ("red", "pink")]
        scores.append((f"c{i}", "x", *[float(80 * kind + rng.random())] * 7))
    df = spark.createDataFrame(lines, "client_code string, client string, product_color string, stems double")
    profile = spark.createDataFrame(scores, "client_code string, client string, " + ", ".join(f"{c} double" for c in clustering.SIMPLE))
    got = {r.client_code: r for r in clustering.cluster_simple(df, profile, k=2).collect()}
    assert {got[f"c{i}"].cluster_name for i in range(1, 40, 2)} == {"CLIENTES_ESTABLES_PARA_TERMINADO"}
    assert {got[f"c{i}"].cluster_name for i in range(0, 40, 2)} == {"CLIENTES_VARIABLES_NO_ANTICIPAR"}
    ranked = clustering.cluster_simple(df, profile, k=4, by="rank").groupBy("cluster_id").count().collect()
    assert sorted((r.cluster_id, r["count"]) for r in ranked) == [(0, 10), (1, 10), (2, 10), (3, 10)]
    assert clustering.cluster_simple(df.where("client_code = 'c1'"), profile).first().cluster_name == "SIN_CLUSTER"
