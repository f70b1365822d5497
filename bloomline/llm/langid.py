"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

The subwords of a text are all three-byte windows of its lower-case letters and word borders, hashed into buckets; texts
are never cut. The mean of their embeddings goes through a linear softmax. Both are trained by stochastic gradient
descent in numpy on a bounded sample (SAMPLE documents of each language at most, chosen by a hash of id and text, at a rate).
As everything after the mean is linear, the two matrices are folded into one for prediction.

A quarter of the sample takes no part in training: on it a temperature is fitted, and the rejection level is set so
that a share of REJECT of the rightly predicted texts at most falls below it.

Defined results: null texts and texts without a letter are ``und`` with score 0; ties go to the first language in
alphabetical order; rows with null language are not learnt from; without any learning row all texts are ``und``; columns
of the input named like an output are replaced; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomline.llm.common import without
from bloomline.llm.quality import remainder

SAMPLE = 1_200
BUCKETS = 1 << 13
WIDTH = 16
REJECT = 0.0005
LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that aren't letters become one kind of border.
BORDER = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def subwords(text: str) -> np.ndarray:
    """Bucket of every window of three bytes; a window of borders alone counts too."""
    raw = np.frombuffer((" " + text.lower() + " ").encode().translate(BORDER), np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)


def shares(text: str) -> np.ndarray:
    at = subwords(text)
    return np.bincount(at, minlength=BUCKETS).astype(np.float32) / max(1, len(at))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # bucket x language: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    level: float  # predictions with a lower score are rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found = [bool(self.languages) and t is not None and LETTER.search(t) is not None for t in texts]
        if not any(found):
            return ["und"] * len(texts), [0.0] * len(texts)
        z = np.stack([shares(t) @ self.table for t, ok in zip(texts, found, strict=True) if ok]) + self.bias
        p = softmax(z / self.temperature)
        best = iter(zip(p.argmax(1).tolist(), p.max(1).astype(float).tolist(), strict=True))
        pairs = [next(best) if ok else None for ok in found]
        return [self.languages[b[0]] if b else "und" for b in pairs], [b[1] if b else 0.0 for b in pairs]


@dataclass(frozen=True)
class Shares:
    """Rows of subword shares, sparse: row k holds amounts at places from starts[k] up to starts[k + 1]."""

    places: np.ndarray
    amounts: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BUCKETS), np.float32)
        for k, row in enumerate(rows.tolist()):
            some = slice(self.starts[row], self.starts[row + 1])
            out[k, self.places[some]] = self.amounts[some]
        return out

    def times(self, table: np.ndarray, rows: np.ndarray) -> np.ndarray:
        parts = [self.dense(rows[k : k + 256]) @ table for k in range(0, len(rows), 256)]
        return np.concatenate(parts) if parts else np.zeros((0, table.shape[1]), np.float32)


def fit(
    x: Shares, rows: np.ndarray, y: np.ndarray, classes: int, epochs: int = 12, batch: int = 64, rate: float = 40.0, seed: int = 11
) -> tuple[np.ndarray, np.ndarray]:
    """Folded table and bias, learnt from these rows of x and their classes y."""
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.3, (BUCKETS, WIDTH)).astype(np.float32)
    w, b = rng.normal(0, 0.3, (WIDTH, classes)).astype(np.float32), np.zeros(classes, np.float32)
    epochs = max(epochs, -(-400 * batch // max(1, len(rows))))  # small samples need as many steps
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(rows))
        for k in range(0, len(rows), batch):
            at = order[k : k + batch]
            some = x.dense(rows[at])
            h = some @ e
            g = softmax(h @ w + b)
            g[np.arange(len(at)), y[at]] -= 1
            g /= len(at)
            ge, gw = g @ w.T, h.T @ g
            e -= step * (some.T @ ge)
            w -= 0.02 * step * gw
            b -= 0.02 * step * g.sum(0)
    return e @ w, b


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """docs: doc_id, text and language of learning rows only."""
    known = docs.select("doc_id", F.col(f"`{text_col}`").alias("body"), F.col(f"`{lang_col}`").alias("label")).where(
        "label is not null and body is not null"
    )
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    bounds = F.create_map(*[F.lit(v) for k, n in sizes.items() for v in (k, min(2**63 - 1, sample * 2**63 // n))])
    # By a hash of id and text: rows with one id, or without, are chosen one by one; of equal rows one is taken.
    named = known.withColumn("name", F.xxhash64("doc_id", "body", F.lit(4)))
    chosen = named.where(F.shiftrightunsigned("name", 1) <= bounds[F.col("label")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, amounts = [], []
            for t in batch.column("body").to_pylist():
                s = shares(t)
                at = np.flatnonzero(s)
                places.append(at.astype(np.uint16).tobytes())
                amounts.append(s[at].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("label", "held", "name")), pa.array(places, pa.binary()), pa.array(amounts, pa.binary())],
                ["label", "held", "name", "places", "amounts"],
            )

    rows = chosen.select("label", F.coalesce(remainder("doc_id", 12) < 3, F.lit(False)).alias("held"), "name", "body")
    made = rows.mapInArrow(run, "label string, held boolean, name bigint, places binary, amounts binary")
    got = made.dropDuplicates(["label", "name"]).toArrow()
    if not len(got):
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    place = {lang: k for k, lang in enumerate(languages)}
    y = np.array([place[lang] for lang in got["label"].to_pylist()], np.int64)
    held, names = np.array(got["held"].to_pylist(), bool), got["name"].to_numpy()
    bytes_of = lambda c: [x.as_buffer() for x in got[c]]
    spots = [np.frombuffer(p, np.uint16) for p in bytes_of("places")]
    starts = np.cumsum([0, *map(len, spots)])
    x = Shares(np.concatenate(spots), np.concatenate([np.frombuffer(p, np.float32) for p in bytes_of("amounts")]), starts)
    del got, spots
    # In an order of the texts' own, so that the fit doesn't depend on the order in which tasks end.
    order = np.lexsort((names, y))
    if not held.any() or held.all():
        held[order] = np.arange(len(y)) % 4 == 3
    learn, rest = order[~held[order]], order[held[order]]
    table, bias = fit(x, learn, y[learn], len(languages))
    z, right = x.times(table, rest) + bias, y[rest]
    tried = np.exp(np.linspace(-3, 3, 61))
    loss = [-np.log(softmax(z / t)[np.arange(len(right)), right] + 1e-12).mean() if len(right) else 0.0 for t in tried]
    temperature = float(tried[int(np.argmin(loss))]) if len(right) else 1.0
    p = softmax(z / temperature)
    good = p.max(1)[p.argmax(1) == right]
    level = float(np.quantile(good, REJECT)) if len(good) else 0.0
    # A level above 1/2 would reject texts that are more likely right than wrong.
    return Model(languages, table.astype(np.float32), bias, temperature, min(level, 0.5))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score and rejected (no letter, or a score below the level)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs, scores = batch.column(text_col).to_pylist(), [], []
            for k in range(0, len(texts), 256):
                a, b = model.predict(texts[k : k + 256])
                langs += a
                scores += b
            rejected = [lang == "und" or s < model.level for lang, s in zip(langs, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                [*batch.schema.names, "lang_pred", "score", "rejected"],
            )

    kept = without(docs, ["lang_pred", "score", "rejected"])
    added = {"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(False)}
    return kept.mapInArrow(run, kept.withColumns(added).schema)
