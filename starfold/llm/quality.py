"""Quality classifier learnt from trusted positives and unlabelled text (positive-unlabelled learning).

A text becomes shares of neighbouring byte kinds (letter, capital, digit, blank,
marks, ...) and a few measures of its words and lines; nothing else is an input.
A linear model is fitted by the non-negative unbiased risk

    prior * mean(loss(positives, +)) + max(0, mean(loss(unlabelled, -)) - prior * mean(loss(positives, -)))

with the logistic loss: where the estimate of the negatives' risk falls below zero,
which is overfitting, the step goes the other way. The class prior is the share
of positives among the labelled training rows, unless given. A last step fits the
scale and offset of the score to the labels of the same rows.

``sample`` bounds the rows that the model is fitted on: so many positives and so
many unlabelled ones, about, picked by a hash of the key from all. Everything
else covers all rows.

Defined cases: a null text counts as empty; an empty text has a score like any
other; a document without a label is unlabelled, one with differing labels too;
without positives every score is the prior, 0.5 if nothing is labelled; a null
key is never held out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import as_bytes, in_fold, own_columns, slices, words
from starfold.sources import stage

#: Rows that the model is fitted on, of each kind.
SAMPLE = 20_000
#: Characters of text that are measured at once when rows are scored in place.
SCORED_CHARS = 2_000_000

_KINDS = [
    range(97, 123), range(65, 91), range(48, 58), b" ", b"\t\n\r", b".", b",", b"!?", b"'\"-():;", b"|",
    b"#$%&*+/<=>@[\\]^_`{}~", range(192, 256), range(128, 192),
]
_KIND = np.full(256, len(_KINDS), np.uint8)
for _i, _members in enumerate(_KINDS):
    _KIND[list(_members)] = _i
_N = len(_KINDS) + 1
FEATURES = _N * _N + 7


def features(texts: list[str | None]) -> np.ndarray:
    """A row of numbers, each about 0 to 1, for each text."""
    data, offsets = as_bytes(texts)
    out = np.zeros((len(texts), FEATURES))
    if not len(texts):
        return out
    starts, ends, hashes = words(data, lower=True)
    first = np.searchsorted(starts, offsets)
    kind = _KIND[data].astype(np.int64)
    pair = kind[:-1] * _N + kind[1:]
    for i in range(len(texts)):
        a, b = int(offsets[i]), int(offsets[i + 1]) - 1
        u, v = int(first[i]), int(first[i + 1])
        n = v - u
        if b > a:
            out[i, : _N * _N] = np.sqrt(np.bincount(pair[a : b - 1], minlength=_N * _N) / max(1, b - a - 1))
        lines = data[a:b].tobytes().split(b"\n")
        length = ends[u:v] - starts[u:v]
        out[i, _N * _N :] = (
            np.log1p(n) / 10,
            min(2.0, length.mean() / 10) if n else 0,
            min(2.0, length.std() / 10) if n else 0,
            len(np.unique(hashes[u:v])) / n if n else 0,
            (hashes[u + 1 : v] == hashes[u : v - 1]).mean() if n > 1 else 0,
            len(set(lines)) / len(lines),
            np.log1p(n / len(lines)) / 10,
        )
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = features(batch.column("text").to_pylist()).astype(np.float16)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["key", "measures"]
        )


@dataclass(frozen=True)
class Model:
    """Score of x: sigmoid(scale * (weights . (x - centre) / spread + bias) + offset)."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    scale: float
    offset: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.spread) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.raw(x) + self.offset)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def nn_risk(z_pos: np.ndarray, z_unl: np.ndarray, prior: float) -> tuple[float, float]:
    """The positive and the (uncorrected) negative part of the unbiased risk, logistic loss."""
    loss = lambda z: np.logaddexp(0, -z)
    return prior * loss(z_pos).mean(), loss(-z_unl).mean() - prior * loss(-z_pos).mean()


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Minimise the non-negative risk."""
    centre, spread = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (np.column_stack([(x - centre) / spread, np.ones(len(x))]).astype(np.float32) for x in (positive, unlabelled))

    def gradient(w: np.ndarray) -> np.ndarray:
        w = w.astype(np.float32)
        zp, zu = p @ w, u @ w
        _, negative = nn_risk(zp, zu, prior)
        of_negative = _sigmoid(zu) @ u / len(u) - prior * (_sigmoid(zp) @ p) / len(p)
        of_positive = -prior * (_sigmoid(-zp) @ p) / len(p)
        shrink = decay * np.append(w[:-1], 0)
        return (of_positive + of_negative if negative >= 0 else -of_negative) + shrink

    w = _descend(gradient, p.shape[1], steps, rate)
    return Model(centre, spread, w[:-1], float(w[-1]), 1.0, 0.0)


def calibrate(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    """Scale and offset by logistic regression of the labels on the raw score."""
    if len(set(y.tolist())) < 2:
        return model
    raw = model.raw(x)
    z = np.column_stack([raw / (raw.std() + 1e-9), np.ones(len(x))])
    w = _descend(lambda w: z.T @ (_sigmoid(z @ w) - y) / len(y) + 1e-4 * np.array([w[0], 0]), 2, 800, 0.05)
    return Model(model.centre, model.spread, model.weights, model.bias, float(max(w[0], 1e-6) / (raw.std() + 1e-9)), float(w[1]))


def train(measures: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", prior: float | None = None, sample: int = SAMPLE) -> tuple[Model | None, float]:
    """The model, or None without positives, and the prior. ``measures`` has key and measures of the training rows."""
    marks = own_columns(labels, key, label).groupBy(F.col(key).alias("key")).agg(F.min(label).alias("y"), F.max(label).alias("y_too"))
    known = measures.join(marks.filter("y = y_too").drop("y_too"), "key", "left")
    rows, ones, zeros = known.agg(F.count(F.lit(1)), F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    if prior is None:
        prior = (ones + 1) / (ones + zeros + 2)
    if not ones:
        return None, prior
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / F.lit(1 << 20)
    some = known.filter((draw < sample / rows) | ((F.col("y") == 1) & (draw < sample / ones)) | ((F.col("y") == 0) & (draw < sample / max(1, zeros))))
    some = some.select("measures", "y", (draw < sample / rows).alias("unlabelled")).toPandas()
    x = np.frombuffer(b"".join(some["measures"]), np.float16).reshape(-1, FEATURES).astype(np.float32)
    y, any_ = some["y"].to_numpy(float, na_value=np.nan), some["unlabelled"].to_numpy(bool)
    if not any_.any():
        any_ = np.ones(len(x), bool)
    model = fit(x[y == 1], x[any_], prior)
    labelled = ~np.isnan(y)
    return calibrate(model, x[labelled], y[labelled]), prior


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", prior: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """One row per document: key, held_out, score (0 to 1, higher: label 1 likelier).

    Held-out rows are those whose crc32 of the key as text is a multiple of 5;
    neither their labels nor their texts are used to learn.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = own_columns(docs, key, text).select(F.col(key).alias("key"), F.col(text).alias("text"))
    measured = stage(rows.mapInArrow(_measure, f"key {kind}, measures binary"), "quality-measures")
    model, prior = train(measured.filter(~in_fold(F.col("key"))), labels, key, label, prior, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("measures").to_pylist()), np.float16).reshape(-1, FEATURES).astype(float)
            got = model.score(x) if model else np.full(len(x), prior)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(got, pa.float64())], names=["key", "score"])

    scored = measured.mapInArrow(score, f"key {kind}, score double")
    return scored.select(F.col("key").alias(key), in_fold(F.col("key")).alias("held_out"), "score")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.3, label: str = "quality") -> DataFrame:
    """The documents scored ``least`` or more, with the columns they had.

    Learnt like ``quality_scores``; the score is applied to the rows themselves, so nothing is joined.
    """
    rows = own_columns(docs, key, text).select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    measured = stage(rows.filter(~in_fold(F.col("key"))).mapInArrow(_measure, f"key {kind}, measures binary"), "quality-measures")
    model, prior = train(measured, labels, key, label)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        own, out = texts.where(texts.notna(), None).tolist(), []
        group = np.cumsum([len(t or "") for t in own]) // SCORED_CHARS  # a batch of rows may hold much text
        for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(group)) + 1):
            x = features([own[i] for i in part]).astype(np.float16).astype(float)
            out.append(model.score(x) if model else np.full(len(x), prior))
        return pd.Series(np.concatenate(out))

    return docs.filter(score(F.col(text)) >= least)
