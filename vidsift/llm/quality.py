"""Quality classifier: a Bradley-Terry model of document pairs, cut at a quantile of its scores.

A document's strength is linear in features of its whole text. The model is fitted on preference pairs (a document
labelled 1 beats one labelled 0) by logistic loss on the differences of their features; the cut is the quantile of
the training documents' strengths at the share of label 0, and scores are logistic in the distance from the cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, release, strings, sums, text_batches, words

#: Byte classes: 1 lower-case letter or byte of a non-ASCII character, 2 upper-case letter, 3 digit, 4 space,
#: 5 line end, 6 sentence mark, 7 bar, 8 other mark.
CLASSES = np.full(256, 8, np.uint8)
CLASSES[list(range(97, 123)) + list(range(128, 256))] = 1
CLASSES[65:91] = 2
CLASSES[48:58] = 3
CLASSES[[32, 9]] = 4
CLASSES[[10, 11, 12, 13]] = 5
CLASSES[[ord(c) for c in ".,;:?'\"()-"]] = 6
CLASSES[ord("|")] = 7

NAMES = ("log_bytes", "lower", "upper", "digit", "space", "line", "stop", "bar", "other", "again", "distinct", "word_bytes", "line_words", "empty")


def features(texts: pa.Array) -> np.ndarray:
    """A row for each text (large_string, no nulls): shares of byte classes, repetition, lengths."""
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    off = at - at[0]
    size = np.diff(off)
    kinds = CLASSES[data]
    shares = [sums(kinds == k, off) / np.maximum(size, 1) for k in range(1, 9)]
    first, codes, _ = words(texts)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), n)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    pairs = np.unique(doc * (int(codes.max(initial=0)) + 1) + codes)
    kinds_n = np.bincount((pairs // (int(codes.max(initial=0)) + 1)).astype(np.int64), minlength=len(texts)) if len(codes) else np.zeros(len(texts))
    w = np.maximum(n, 1)
    return np.stack([np.log1p(size), *shares, sums(same, first) / w, (kinds_n / w) * np.log1p(n), size / w / 10, np.log1p(n / (sums(kinds == 5, off) + 1)), size == 0], axis=1).astype(np.float64)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    cut: float
    spread: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.strength(x) - self.cut) / self.spread, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 200_000, l2: float = 1e-3, seed: int = 7) -> Model:
    """Fit on feature rows and 0/1 labels. With one label only, or no rows, every score is 0.5 or above for label 1
    only, below for label 0 only."""
    k = x.shape[1] if x.ndim == 2 else len(NAMES)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(k), np.zeros(k), np.ones(k), 1.0 if len(y) and not y.max() else 0.0, 1.0)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(np.flatnonzero(y == 1), pairs)] - z[rng.choice(np.flatnonzero(y == 0), pairs)]
    w = np.zeros(k)
    for _ in range(50):
        p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))  # chance that the labelled loser wins
        g = d.T @ p / pairs - l2 * w
        h = (d * (p * (1 - p))[:, None]).T @ d / pairs + l2 * np.eye(k)
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    s = z @ w
    return Model(w, mean, scale, float(np.quantile(s, (y == 0).mean())), float(max(s.std(), 1e-6)))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", max_rows: int = 20_000) -> Model:
    """Fit on at most ``max_rows`` labelled documents, the first by a hash of their id. Labels other than 0 and 1,
    and null ids, are left out; of several labels of a document the least counts, and of rows that share an id the least
    text, so that ``max_rows`` bounds what comes to the driver whatever repeats."""
    from pyspark.sql.types import LongType, StructField, StructType

    spark = docs.sparkSession
    ids = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("long").alias("y"))
    chosen = bounded_sample(ids, max_rows)
    small = spark.createDataFrame([(int(r.id), int(r.y)) for r in chosen], StructType([StructField("id", LongType()), StructField("y", LongType())]))
    found = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(small), "id")
    found = found.groupBy("id", "y").agg(F.min("text").alias("text"))

    def rows(batches):
        for b in text_batches(batches):
            x = features(strings(b.column("text")))
            yield pa.record_batch([b.column("id"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "y", "x"])

    got = sorted(map(tuple, found.mapInArrow(rows, "id long, y long, x array<double>").collect()))
    return fit(np.array([g[2] for g in got]), np.array([g[1] for g in got]))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for each row; null texts score as empty ones, repeated rows each get a row."""

    def rows(batches):
        for b in text_batches(batches):
            s = model.score(features(strings(b.column("text"))))
            yield pa.record_batch([b.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(rows, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of docs that score 0.5 or more, unchanged."""

    def rows(batches):
        for b in text_batches(batches, text=text):
            yield b.filter(pa.array(model.score(features(strings(b.column(text)))) >= 0.5))
        release()

    return docs.mapInArrow(rows, docs.schema)
