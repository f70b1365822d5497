"""Quality classifier by positive-unlabelled learning.

A text becomes the square roots of the shares of its neighbouring byte classes (letters, digits, each kind of
punctuation, line ends, ...) and a few whole-text ratios; texts are never cut. A linear model minimises the
non-negative unbiased risk: with class prior p, sigmoid loss l, positives P and unlabelled texts U it is
p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]); where the second part turns negative the step goes the other way.

Trusted positives are learning rows labelled 1. The class prior is the share of label 1 among learning rows. A third of
the learning rows takes no part in the fit: on it a logistic curve turns the model's output into the probability of
label 1. Fitting uses bounded samples (SAMPLE rows of each kind at most, chosen by a hash of id and text, at a rate); scoring
runs over every row.

Defined results: null and empty texts have all ratios 0 and get the score of such a vector; equal rows and equal
labels count once in the fit, rows with null label or id are no labels; without any positive label every score is the prior (0.5 if there are no
labels at all); columns of the input named like an output are replaced; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bloomline.llm.common import without

#: Rows of each kind (positives, unlabelled, calibration) that the fit may collect.
SAMPLE = 4_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.int64)  # 0: control bytes
    kind[ord("a") : ord("z") + 1] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[32], kind[10], kind[[9, 13]] = 4, 5, 6
    kind[0x80:0xC0], kind[0xC0:] = 7, 8
    for k, c in enumerate(PUNCTUATION):
        kind[c] = 9 + k
    return kind


KIND = _classes()
KINDS = int(KIND.max()) + 1
RATIOS = 6
WIDTH = KINDS * KINDS + RATIOS


def features(text: str | None) -> np.ndarray:
    """The vector of one whole text."""
    out = np.zeros(WIDTH, np.float32)
    raw = (text or "").encode()
    kinds = KIND[np.frombuffer(raw, np.uint8)]
    if len(kinds) > 1:
        pairs = np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS * KINDS)
        out[:-RATIOS] = np.sqrt(pairs / (len(kinds) - 1))
    words, lines = raw.split(), raw.split(b"\n")
    if words:
        n = len(words)
        out[-RATIOS:] = (
            len(set(words)) / n, len(set(lines)) / len(lines), len(raw) / n / 10, np.log1p(n) / 10,
            len(set(words)) / n ** 0.8, 1.0,
        )
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    slope: float
    shift: float

    def output(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.output(x) + self.shift)


def fit_pu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, batch: int = 512,
    rate: float = 0.01, decay: float = 1e-3, seed: int = 7,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the last is the constant), mean and scale of the features. Features may be of half precision: only
    batches of them are widened."""
    mean = unlabelled.mean(0, dtype=np.float32)
    square = sum((unlabelled[k : k + batch].astype(np.float32) ** 2).sum(0) for k in range(0, len(unlabelled), batch))
    scale = np.sqrt(np.maximum(square / len(unlabelled) - mean**2, 0)) + np.float32(0.02)
    p, u = positive, unlabelled
    rng, w = np.random.default_rng(seed), np.zeros(p.shape[1] + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        xp, xu = ((x[rng.integers(len(x), size=min(batch, len(x)))] - mean) / scale for x in (p, u))
        sp, su = sigmoid(xp @ w[:-1] + w[-1]), sigmoid(xu @ w[:-1] + w[-1])
        # l(z) = sigmoid(-z); with s = sigmoid(f), l(f) = 1 - s and l(-f) = s, both of slope s (1 - s).
        dp, du = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        negative = su.mean() - prior * sp.mean()
        gp, gu = (-prior * dp - prior * dp, du) if negative >= 0 else (prior * dp, -du)
        gp, gu = gp.astype(np.float32), gu.astype(np.float32)
        g = np.r_[gp @ xp + gu @ xu, gp.sum() + gu.sum()]
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w, mean, scale


def fit_curve(z: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and shift of the logistic curve of y over z (Newton's method with a weak prior on both)."""
    x, theta = np.c_[z, np.ones(len(z))], np.zeros(2)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(steps):
        q = sigmoid(x @ theta)
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(h, x.T @ (q - target) + 1e-3 * theta)
    return float(theta[0]), float(theta[1])


def remainder(id_col: str, modulus: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def at_most(hashed: Column, wanted: int, rows: int) -> Column:
    """Whether a row is among about wanted of so many: its 64-bit hash lies below that share of all hashes, at any number of rows."""
    return F.shiftrightunsigned(hashed, 1) <= F.lit(min(2**63 - 1, wanted * 2**63 // max(1, rows)))


def sampled(rows: DataFrame, wanted: int, salt: int) -> DataFrame:
    """About so many rows (all, if there are fewer), chosen by a hash of their name: of repeats all or none."""
    return rows.where(at_most(F.xxhash64("name", F.lit(salt)), wanted, rows.count())).distinct()


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fits the model. docs: doc_id and the text; labels: doc_id and quality, learning rows only."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    held = remainder("doc_id", 12)  # of the learning rows, for the curve
    fitted, curve = known.where(held >= 4).distinct(), known.where(held < 4).distinct()
    # A row's name is a hash of its id and text, so rows that share an id are chosen one by one.
    texts = docs.select("doc_id", F.col(f"`{text_col}`").alias("body")).where("doc_id is not null").withColumn("name", F.xxhash64("doc_id", "body"))
    ids = texts.select("doc_id", "name")
    role = lambda kind, y: [F.lit(kind).alias("role"), y.cast("int").alias("y")]
    parts = [
        sampled(ids.join(fitted.where("quality = 1"), "doc_id").select("name", *role("p", F.lit(1))), sample, 1),
        sampled(ids.select("name", *role("u", F.lit(0))), sample, 2),
        sampled(ids.join(curve, "doc_id").select("name", *role("c", F.col("quality"))), sample, 3),
    ]
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("s")).first()
    prior = counts.s / counts.n if counts.n else 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = []
            for t in batch.column("body").to_pylist():
                row = features(t).astype(np.float16)
                at = np.flatnonzero(row).astype(np.uint16)  # most pairs of classes never meet
                x.append(at.tobytes() + row[at].tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("role", "y", "name")), pa.array(x, pa.binary())], ["role", "y", "name", "x"])

    chosen = parts[0].unionByName(parts[1]).unionByName(parts[2])
    # At most about three samples of names: a proven bound for the broadcast and, equal rows being one, for what is collected.
    wanted = texts.join(F.broadcast(chosen), "name").select("role", "y", "name", "body")
    made = wanted.mapInArrow(run, "role string, y int, name bigint, x binary")
    got = made.dropDuplicates(["role", "y", "name"]).select("role", "y", "x").toArrow()
    role, y = np.array(got["role"].to_pylist(), str), np.array(got["y"].to_pylist(), float)
    x, names = np.zeros((len(role), WIDTH), np.float16), np.zeros(len(role), np.uint64)
    for k, packed in enumerate(got["x"]):
        at, value = np.frombuffer(packed.as_buffer(), np.uint16).reshape(2, -1)
        x[k, at] = value.view(np.float16)
        names[k] = xxhash.xxh64_intdigest(packed.as_buffer())
    del got
    # In an order of the texts' own, so that the fit doesn't depend on the order in which tasks end.
    of = lambda kind: (found := np.flatnonzero(role == kind))[np.lexsort((names[found], y[found]))]
    if not (role == "p").any() or not (role == "u").any():
        edge = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        return Model(np.zeros(WIDTH + 1), np.zeros(WIDTH), np.ones(WIDTH), 0.0, float(edge))
    w, mean, scale = fit_pu(x[of("p")], x[of("u")], prior)
    model = Model(w.astype(np.float32), mean, scale, 1.0, 0.0)
    if (role == "c").any():
        curve = of("c")
        slope, shift = fit_curve(model.output(x[curve]).astype(float), y[curve])
        model = Model(model.weights, mean, scale, slope, shift)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with the probability of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, scores = batch.column(text_col).to_pylist(), []
            for k in range(0, len(texts), 256):
                scores += model.score(np.stack([features(t) for t in texts[k : k + 256]])).astype(float).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col])

    kept = without(docs, [score_col])
    return kept.mapInArrow(run, kept.withColumn(score_col, F.lit(0.0)).schema)
