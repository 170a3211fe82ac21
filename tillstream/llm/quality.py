"""Quality by pairwise ranking (Bradley-Terry).

A document's score is linear in features of its whole text: shares of byte values, and a few
measures of words, lines, repetition and length. Of every preference pair (a text marked good, one
marked bad) the chance that the first wins is the logistic of the score difference; the weights
minimize the logistic loss over pairs with a ridge, by Newton steps. The threshold is the quantile
of the scores of all labelled rows that aren't held out, at the share of bad labels; the score given
out is the logistic of the distance to it, so 0.5 is the threshold.

The fit of the weights takes at most `SAMPLE_PER_CLASS` labelled rows of each class, chosen by a hash of
doc_id, and `PAIRS` pairs of them. Everything else covers all rows: for the threshold, all documents are
scored once, and labelled scores are counted by steps of 1 / `STEPS`.

Null text counts as empty, and empty texts get a score like any other. Long texts are measured whole.
Labels whose doc_id or
quality is null are left out; several labels of one doc_id count by their mean. Without labels
of both classes all scores are 0.5. Rows that repeat a doc_id each get a row. A null doc_id is
scored and not held out. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, as_bytes, slices, text_key

SAMPLE_PER_CLASS = 4000
PAIRS = 40_000
RIDGE = 1.0
NEWTON_STEPS = 12
# Scores are counted for the threshold in steps of this part of a log odds, between these bounds.
STEPS = 1024
FARTHEST = 64

_MEASURES = 8
FEATURES = 129 + _MEASURES


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of ASCII bytes and of all others, then the measures."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    out = np.zeros(FEATURES)
    size = max(1, len(text))
    out[:128] = np.sqrt(counts[:128] / size)
    out[128] = np.sqrt(counts[128:].sum() / size)
    words, lines = text.split(), text.split(b"\n")
    some = max(1, len(words))
    out[129:] = (
        np.log1p(len(words)),
        len(set(words)) / some,
        sum(map(len, words)) / some,
        len(set(lines)) / len(lines),
        np.log1p(len(text) / len(lines)),
        len(zlib.compress(text, 1)) / size,
        np.log1p(size),
        counts[65:91].sum() / max(1.0, counts[65:91].sum() + counts[97:123].sum()),
    )
    return out


@dataclass(frozen=True)
class Model:
    """Score of features x is (x - mean) . weights - threshold, in units of log odds."""

    mean: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return (np.array([features(t) for t in texts]) - self.mean) @ self.weights

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(texts) - self.threshold, -500, 500)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, seed: int = 7) -> Model:
    """Bradley-Terry weights from good and bad feature rows; the threshold is 0 yet."""
    if not len(good) or not len(bad):
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), 0.0)
    both = np.concatenate([good, bad])
    mean, spread = both.mean(axis=0), both.std(axis=0)
    # A column that hardly varies in the sample says nothing about other texts.
    scale = np.where(spread > 1e-4, 1 / np.maximum(spread, 1e-4), 0.0)
    random = np.random.default_rng(seed)
    differences = (good[random.integers(0, len(good), PAIRS)]
                   - bad[random.integers(0, len(bad), PAIRS)]) * scale
    weights = np.zeros(FEATURES)
    for _ in range(NEWTON_STEPS):
        lost = 1 / (1 + np.exp(np.clip(differences @ weights, -500, 500)))
        slope = RIDGE * weights - differences.T @ lost
        curve = (differences * (lost * (1 - lost))[:, None]).T @ differences
        weights -= np.linalg.solve(curve + RIDGE * np.eye(FEATURES), slope)
    return Model(mean, weights * scale, 0.0)


def quantile_step(steps: list[int], counts: list[int], share: float) -> float:
    """Of numbers counted by step, a bound with this share of them below, in steps: in the middle of the
    gap up to the next step that has any."""
    order = np.argsort(steps)
    steps, counts = np.array(steps)[order], np.array(counts)[order]
    at = min(int(np.searchsorted(np.cumsum(counts), share * counts.sum() - 1e-9)), len(steps) - 1)
    after = min(at + 1, len(steps) - 1)
    return float(steps[at] + 1 + steps[after]) / 2 if after > at else float(steps[at]) + 1


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether crc32 of the doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labels that aren't held out."""
    known = (labels.where("doc_id is not null and quality is not null")
             .where(~held_out())
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg((F.avg("quality") >= 0.5).alias("good")))
    counts = {row["good"]: row["count"] for row in known.groupBy("good").count().collect()}

    def sample(good: bool) -> DataFrame:
        return (known.where(F.col("good") == good)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS))

    chosen = sample(True).unionByName(sample(False))
    # At most 2 x SAMPLE_PER_CLASS ids.
    rows = documents.select(F.col("doc_id").cast("bigint"), text_key().alias("text_key"), "text")
    rows = rows.join(F.broadcast(chosen), "doc_id")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [features(t).astype(np.float32).tobytes() for t in as_bytes(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("good"),
                 pa.array(values, pa.binary())], ["doc_id", "text_key", "good", "features"])

    found = sorted(arrow_map(rows, measured,
                             "doc_id bigint, text_key bigint, good boolean, features binary")
                   .distinct().collect())

    def matrix(good: bool) -> np.ndarray:
        return np.array([np.frombuffer(r["features"], np.float32) for r in found
                         if r["good"] == good], np.float64).reshape(-1, FEATURES)

    model = fit_pairs(matrix(True), matrix(False))
    if not counts.get(True) or not counts.get(False):
        return model
    bad_share = counts[False] / (counts[True] + counts[False])
    return replace(model, threshold=_threshold(documents, known, model, bad_share))


def _threshold(documents: DataFrame, known: DataFrame, model: Model, bad_share: float) -> float:
    """The quantile of all labelled scores at the share of bad labels."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = np.clip(model.raw(as_bytes(batch)), -FARTHEST, FARTHEST)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.floor(raw * STEPS).astype(np.int32))],
                ["doc_id", "step"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text").where("doc_id is not null")
    steps = arrow_map(rows, measured, "doc_id bigint, step int")
    found = steps.join(known.select("doc_id"), "doc_id").groupBy("step").count().collect()
    if not found:
        return 0.0
    return quantile_step([r["step"] for r in found], [r["count"] for r in found], bad_share) / STEPS


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.scores(as_bytes(batch)))],
                ["doc_id", "score"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return arrow_map(rows, scored, "doc_id bigint, score double").select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents, all their columns, whose score is 0.5 or more. No shuffle."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(model.scores(as_bytes(batch)) >= 0.5))

    return arrow_map(documents, kept, documents.schema)
