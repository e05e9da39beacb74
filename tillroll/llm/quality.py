"""Quality classifier learnt from trusted positives and unlabelled text.

A linear model over surface figures in bins and hashed byte triples minimises the non-negative
unbiased risk: with class prior p, positives P and unlabelled text U,
p R+(P) + max(0, R-(U) - p R-(P)); where the second part falls below zero the step goes the other way.
The prior is estimated first: a plain classifier tells P from U, and above its upper score levels the
share of U over the share of P tends to p, as few negatives are left there. No label 0 is used.

Null and empty texts have the figures of an empty text and get its score. With no positives or no
text to learn from every score is 0.5. Repeated rows and long texts are scored like any others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm.shared import records, text_of, text_parts
from tillroll.llm.stats import STATS, Adam, Levels, text_stats
from tillroll.llm.training import held_out, labelled

MOD, REST = 5, 0  # held-out rows
THRESHOLD = 0.3
POSITIVES, UNLABELLED = 5000, 8000  # rows of the bounded sample
TRIPLES = 512
TRIPLE_WEIGHT = 2.0
SHORT = 100  # triples below which a text says little
STEPS = 160
DECAY = 5e-3
PRIOR_DECAY = 1e-2


def _byte_classes() -> np.ndarray:
    """Lower-case letters and signs as they are, one class each for capitals, digits and high bytes."""
    out = np.arange(256, dtype=np.uint32)
    out[65:91], out[48:58], out[128:], out[9:14] = 65, 48, 128, 32
    out[10] = 10
    return out


CLASS = _byte_classes()


def triples(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed byte-class triples in each text, less for short ones."""
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, TRIPLES), np.float32)
    c = CLASS[data]
    h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    place = (h >> np.uint32(16)) % np.uint32(TRIPLES)
    rows = np.repeat(np.arange(n), np.diff(offsets))[:-2]
    inside = np.repeat(offsets[1:], np.diff(offsets))[:-2] >= np.arange(len(h)) + 3
    found = np.bincount(rows[inside] * TRIPLES + place[inside], minlength=n * TRIPLES).reshape(n, TRIPLES)
    return np.sqrt(found / (found.sum(axis=1, keepdims=True) + SHORT)).astype(np.float32)


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, data, offsets in text_parts(column):
        yield text_stats(data, offsets), triples(data, offsets)


def sample_features(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Figures, triples and labels of a bounded sample, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.concatenate([a, b], axis=1) for a, b in features(batch["text"])]
            if found:
                both = [x.tobytes() for x in np.concatenate(found).astype("<f4")]
                yield pa.RecordBatch.from_arrays([batch["label"].cast(pa.int32()), pa.array(both, pa.binary())], ["label", "row"])

    got = rows.mapInArrow(run, "label int, row binary").toArrow()
    if not got.num_rows:
        return np.zeros((0, len(STATS)), np.float32), np.zeros((0, TRIPLES), np.float32), np.zeros(0, int)
    raw = got["row"].combine_chunks()
    both = np.stack([np.frombuffer(r.as_py(), "<f4") for r in raw])
    order = np.lexsort([*both[:, :4].T, got["label"].to_numpy()])  # the fit does not depend on arrival
    both, label = both[order], got["label"].to_numpy()[order]
    return both[:, : len(STATS)], both[:, len(STATS) :], label


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _halves(n: int) -> list[np.ndarray]:
    even = np.arange(n) % 2 == 0
    return [even, ~even]


def _descend(x: np.ndarray, slope, steps: int, decay: float) -> tuple[np.ndarray, float]:
    values = {"w": np.zeros(x.shape[1], np.float64), "b": np.zeros(1)}
    adam = Adam(0.05)
    for _ in range(steps):
        g = slope(x @ values["w"].astype(np.float32) + values["b"][0])
        adam.step(values, {"w": x.T @ g.astype(np.float32) + decay * values["w"], "b": np.array([g.sum()])})
    return values["w"], float(values["b"][0])


def estimate_prior(x: np.ndarray, positive: np.ndarray) -> float:
    """Share of positives in the unlabelled rows; fitted on one half of the sample, read off the other."""
    shares = []
    for half in _halves(len(x)):
        p = positive[half]
        n_p, n_u = max(p.sum(), 1), max((~p).sum(), 1)
        w, b = _descend(x[half], lambda f: np.where(p, (sigmoid(f) - 1) / n_p, sigmoid(f) / n_u) / 2, 80, PRIOR_DECAY)
        score = x[~half] @ w + b
        ps, us = score[positive[~half]], score[~positive[~half]]
        if len(ps) and len(us):
            shares += [(us >= t).mean() / (ps >= t).mean() for t in np.quantile(ps, np.linspace(0.05, 0.5, 10))]
    return float(np.clip(np.median(shares), 0.05, 0.98)) if shares else 0.5


def risk_slope(positive: np.ndarray, prior: float):
    """Slope of the non-negative risk in the scores of the sample."""
    n_p, n_u = max(int(positive.sum()), 1), max(int((~positive).sum()), 1)

    def slope(f: np.ndarray) -> np.ndarray:
        s = sigmoid(f)  # slope of the loss for label 0; for label 1 it is s - 1
        loss = np.logaddexp(0, f)
        below = loss[~positive].sum() / n_u - prior * loss[positive].sum() / n_p < 0
        sign = -1.0 if below else 1.0
        out = np.empty_like(s)
        out[positive] = ((0 if below else 1) * prior * (s[positive] - 1) - sign * prior * s[positive]) / n_p
        out[~positive] = sign * s[~positive] / n_u
        return out

    return slope


class Calibration:
    """Posterior sigmoid(a f + c) of the positive class, fitted to P and U alone.

    With the prior p a row of the sample comes from P with odds (n_P / n_U) (posterior / p); a and c
    maximise the likelihood of where the rows came from.
    """

    def __init__(self, f: np.ndarray, positive: np.ndarray, prior: float):
        self.centre, self.width = float(f.mean()), float(f.std()) or 1.0
        z = (f - self.centre) / self.width
        weight = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum())
        values = {"a": np.ones(1), "c": np.zeros(1)}
        adam = Adam(0.05)
        for _ in range(400):
            post = sigmoid(values["a"] * z + values["c"])
            own = post / (post + prior)  # both origins weigh the same
            g = weight * np.where(positive, own - 1, own) * (1 - post)
            adam.step(values, {"a": np.array([(g * z).sum()]), "c": np.array([g.sum()])})
        self.a, self.c = max(float(values["a"][0]), 1e-3), float(values["c"][0])

    def __call__(self, f: np.ndarray) -> np.ndarray:
        return sigmoid(self.a * (f - self.centre) / self.width + self.c)


class QualityModel:
    def __init__(self, stats: np.ndarray, triple: np.ndarray, label: np.ndarray, steps: int = STEPS):
        self.levels = Levels(stats)
        self.w = np.zeros(self.levels.width + TRIPLES)
        self.b, self.prior, self.calibration = 0.0, 0.5, None
        positive = label == 1
        n_p, n_u = int(positive.sum()), int((label == -1).sum())
        if not n_p or not n_u:
            return
        x = np.concatenate([self.levels(stats), triple * TRIPLE_WEIGHT], axis=1)
        prior = self.prior = estimate_prior(x, positive)
        self.w, self.b = _descend(x, risk_slope(positive, prior), steps, DECAY)
        unseen = np.zeros(len(x))  # scores by a model that did not see the row
        for half in _halves(len(x)):
            w, b = _descend(x[half], risk_slope(positive[half], prior), steps, DECAY)
            unseen[~half] = x[~half] @ w + b
        self.calibration = Calibration(unseen, positive, prior)

    def scores(self, stats: np.ndarray, triple: np.ndarray) -> np.ndarray:
        at = self.levels.width
        f = self.levels(stats) @ self.w[:at] + TRIPLE_WEIGHT * (triple @ self.w[at:]) + self.b
        return np.full(len(f), 0.5) if self.calibration is None else self.calibration(f)


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    rows = labelled(docs, labels, "quality", MOD, REST, {1: POSITIVES}, UNLABELLED)
    return QualityModel(*sample_features(rows))


def scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents with ``quality_score`` as their last column, the text's own column names kept; rows may come as ``record`` (see ``records``)."""
    schema = docs.schema
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spread.value.scores(*f) for f in features(text_of(batch))]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, "quality_score"])

    return docs.mapInArrow(run, T.StructType([*schema.fields, T.StructField("quality_score", T.DoubleType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row."""
    model = fit(docs, labels)
    rows = scored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model)
    return rows.select(
        "doc_id", held_out(MOD, REST).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The documents that the classifier takes for good text; columns as they came."""
    return scored(records(docs), model).filter(F.col("quality_score") >= THRESHOLD).select("record.*")
