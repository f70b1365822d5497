"""Embedding whitening by contour integration.

An entry c of a vector becomes the whole number x = floor(64 * c) + 1000000, so that counts and sums are exact. The fit list is
each different x vector once. Its covariance V (divisor n, centred first) is summed up by Spark from one matrix for each task;
eigenvalues of V are counted by inertia (signs of the pivots of V - shift) at many shifts at a time, which cuts the upper end of
the spectrum into intervals of few eigenvalues each; each interval is a row of a Spark job: quadrature of the solves of
(z - V) Q = Y along a circle around the interval projects onto its eigenvectors, Rayleigh-Ritz takes them out, and the counts at
both ends say how many there must be.

Defined cases. Rows whose vector is null, empty, of another length than most (of equally frequent lengths the longest counts) or
holds an entry that is null, not finite or beyond 2**46 in size are left out. Repeated vectors count once in the fit and get a row
each. Components whose eigenvalue is under 1e-11 of the largest count as zero and aren't given, as whitening would divide by
rounding errors; so a table of equal vectors, like an empty one, has no components. A deviation beyond a long is null.
Columns of the input stay, but for those named like an output.
Bound: V is one matrix of length x length doubles on the driver and in tasks; vectors longer than LONGEST are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bloomline.llm.common import stored, without

SCALE, ZERO = 64, 1_000_000
#: Longest vectors: their covariance must fit into a task.
LONGEST = 4096
LARGEST_ENTRY = float(2**46)
#: Eigenvalues under this share of the largest count as zero.
NOISE = 1e-11
#: Intervals are cut until they hold so many eigenvalues, in so many rounds of so many cuts; what equals stays together.
SLICE, ROUNDS, CUTS = 8, 6, 8
#: Points of the quadrature on the half circle, and rounds of the projection.
NODES, TURNS = 8, 30


@dataclass
class Whitening:
    """What fit() gives: the exact sums of the n different x vectors, and unit eigenvectors by falling eigenvalue."""

    n: int
    sums: list[int]
    trace: float
    values: list[float] = field(default_factory=list)
    vectors: np.ndarray | None = None
    identity_error: float = 0.0

    @property
    def length(self) -> int:
        return len(self.sums)


def usable(vector: str):
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= LARGEST_ENTRY), F.lit(False)))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & good


def grid(vector: str):
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(ZERO).cast("bigint"))


def fit(df: DataFrame, vector: str, components: int = 16) -> Whitening:
    x = df.where(usable(vector)).select(grid(vector).alias("x")).distinct()
    fit_list = stored(x, "whitening")
    common = fit_list.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if common is None:
        return Whitening(0, [], 0.0)
    if common.length > LONGEST:
        raise ValueError(f"vectors have {common.length} entries, the covariance is bounded to {LONGEST}")
    n, length = common["count"], common.length
    fit_list = fit_list.where(F.size("x") == length)
    model = Whitening(n, column_sums(fit_list, length), 0.0)
    covariance = summed(fit_list, length, length, lambda x: deviations(x, model) / n) / n
    model.trace = float(np.trace(covariance))
    model.values, model.vectors = leading_eigenpairs(df, covariance, components)
    if model.values:
        k = len(model.values)
        whitened = summed(fit_list, length, k, lambda x: projected(x, model)) / n
        model.identity_error = float(np.abs(whitened - np.eye(k)).max())
    return model


def apply(df: DataFrame, vector: str, model: Whitening) -> DataFrame:
    """The usable rows of df with x as grid, the exact deviation and the whitened array (entry k of component k + 1)."""
    kept = df.where(usable(vector) & (F.size(vector) == model.length))
    kept = without(kept, ["grid", "deviation", "whitened"]).withColumn("grid", grid(vector))
    out = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(batch.schema.names.index("grid")), model.length)
            exact = (whole(x, model) ** 2).sum(1).tolist()
            far = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            flat = projected(x, model)
            ends = pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, far, lists], [*batch.schema.names, "deviation", "whitened"])

    if not model.length:
        return kept.select("*", F.lit(None).cast("bigint").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    return kept.mapInArrow(project, T.StructType([*kept.schema.fields, *out]))


# Sums over the fit list


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def deviations(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S as exact whole numbers: longs where they fit, Python's own where not."""
    if model.n * max(int(np.abs(x).max(initial=0)), 1) < 2**61:
        return model.n * x - np.array(model.sums)
    return (x.astype(object) * model.n - np.array(model.sums, object)).astype(object)


def whole(x: np.ndarray, model: Whitening) -> np.ndarray:
    d = deviations(x, model)
    return d if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * model.length < 2**62 else d.astype(object)


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    if not model.values:
        return np.zeros((len(x), 0))
    centred = (deviations(x, model) / model.n).astype(float)
    return centred @ (model.vectors / np.sqrt(model.values)[:, None]).T


def column_sums(fit_list: DataFrame, length: int) -> list[int]:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, object)
        for batch in batches:
            x = matrix(batch.column(0), length)
            small = len(x) * max(int(np.abs(x).max(initial=0)), 1) < 2**62
            total += x.sum(0).astype(object) if small else x.astype(object).sum(0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(length), pa.int32()), pa.array([str(v) for v in total])], ["i", "part"]
        )

    parts = fit_list.mapInArrow(add, "i int, part string")
    rows = parts.groupBy("i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    return [int(r.total) for r in sorted(rows)]


def summed(fit_list: DataFrame, length: int, width: int, rows_of) -> np.ndarray:
    """The sum of r^T r over all rows r = rows_of(x): a matrix for each task, whose rows are then added by Spark."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            r = rows_of(matrix(batch.column(0), length)).astype(float)
            total += r.T @ r
        rows = pa.array(total.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), rows], ["i", "part"])

    parts = fit_list.mapInArrow(add, "i int, part array<double>")
    cells = parts.select("i", F.posexplode("part").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("cells")).collect()
    return np.array([[c.v for c in r.cells] for r in sorted(rows, key=lambda r: r.i)])


# Eigenpairs


def below(v: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of the symmetric v under shift: negative pivots of v - shift, in blocks of one or two rows."""
    a = v - shift * np.eye(len(v))
    negative = 0
    while len(a):
        diagonal, other = np.abs(np.diag(a)), np.abs(a - np.diag(np.diag(a)))
        p, (q, r) = int(diagonal.argmax()), np.unravel_index(other.argmax(), other.shape)
        if diagonal[p] == 0 and other[q, r] == 0:
            return negative
        rows = [p] if diagonal[p] >= 0.64 * other[q, r] else [int(q), int(r)]
        negative += int(a[p, p] < 0) if len(rows) == 1 else 1
        rest = np.delete(np.arange(len(a)), rows)
        side = a[np.ix_(rest, rows)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(rows, rows)], side.T)
    return negative


def within(v: np.ndarray, low: float, high: float, expected: int) -> tuple[np.ndarray, np.ndarray]:
    """The expected eigenpairs of v in [low, high) by contour integration; the subspace grows until all are found."""
    d = len(v)
    middle, radius = (low + high) / 2, (high - low) / 2
    x, weights = np.polynomial.legendre.leggauss(NODES)
    points = radius * np.exp(-0.5j * np.pi * (x - 1))
    size = min(d, 2 * expected + 8)
    while True:
        q = np.random.default_rng(size).standard_normal((d, size))
        residual = np.inf
        for _ in range(TURNS):
            if size < d:
                solves = [w * np.real(p * np.linalg.solve((middle + p) * np.eye(d) - v, q)) for p, w in zip(points, weights, strict=True)]
                q = np.sum(solves, axis=0) / 2
            q, _ = np.linalg.qr(q)
            values, small = np.linalg.eigh(q.T @ v @ q)
            q = q @ small
            inside = (values >= low) & (values < high)
            before, residual = residual, np.abs(v @ q[:, inside] - q[:, inside] * values[inside]).max(initial=0)
            if size == d or inside.sum() == expected and (residual <= 1e-15 * d * abs(high) or residual >= before):
                break
        if inside.sum() == expected or size == d:
            return values[inside], q[:, inside]
        size = min(d, 2 * size)


def leading_eigenpairs(df: DataFrame, v: np.ndarray, components: int) -> tuple[list[float], np.ndarray | None]:
    """Up to so many largest eigenvalues with unit eigenvectors (rows); inertia says whether one is missed."""
    spark, d = df.sparkSession, len(v)
    at_once = spark.sparkContext.defaultParallelism
    top = float(np.abs(v).sum(1).max()) * 1.0137
    if not top > 0:
        return [], None

    def over(shifts: list[float]) -> dict[float, int]:
        def count(batches):
            for batch in batches:
                batch["n"] = [d - below(v, s) for s in batch["shift"]]
                yield batch

        asked = spark.createDataFrame([(s,) for s in shifts], "shift double").repartition(min(len(shifts), at_once))
        return {r.shift: r.n for r in asked.mapInPandas(count, "shift double, n int").collect()}

    # Shifts that halve go down to the noise; then intervals with many eigenvalues are cut evenly.
    ladder = over([top, *(top * 0.5**k for k in range(1, 40) if 0.5**k > NOISE)])
    counts, floor = {}, None
    for shift in sorted(ladder, reverse=True):
        counts[shift] = ladder[shift]
        floor = shift
        if ladder[shift] >= components:
            break
    for _ in range(ROUNDS):
        edges = sorted(counts)
        wide = [(a, b) for a, b in zip(edges, edges[1:], strict=False) if counts[a] - counts[b] > SLICE and b - a > 1e-9 * top]
        if not wide:
            break
        counts |= over([a + (b - a) * k / CUTS for a, b in wide for k in range(1, CUTS)])
    floor = max(s for s in counts if s >= floor and counts[s] >= min(components, counts[floor]))
    edges = sorted(s for s in counts if s >= floor)
    slices = [(a, b, counts[a] - counts[b]) for a, b in zip(edges, edges[1:], strict=False) if counts[a] > counts[b]]
    if not slices:
        return [], None

    def solve(batches):
        for batch in batches:
            for a, b, expected in batch[["low", "high", "expected"]].itertuples(index=False):
                values, vectors = within(v, a, b, int(expected))
                yield pd.DataFrame({"low": a, "value": values, "vector": list(vectors.T)})

    asked = spark.createDataFrame(slices, "low double, high double, expected int").repartition(min(len(slices), at_once))
    rows = asked.mapInPandas(solve, "low double, value double, vector array<double>").collect()
    for a, b, expected in slices:
        found = sum(r.low == a for r in rows)
        if found != expected:
            raise RuntimeError(f"{found} of {expected} eigenvalues found between {a} and {b}")
    best = sorted(rows, key=lambda r: -r.value)[:components]
    vectors = np.array([r.vector for r in best])
    signs = np.sign(vectors[np.arange(len(best)), np.abs(vectors).argmax(1)])
    values = [r.value for r in best if r.value > NOISE * best[0].value]
    return values, (vectors * signs[:, None])[: len(values)]

