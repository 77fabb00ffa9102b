"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its words, pairs of neighbours and pairs with one word between them, each hashed to one of 2^`bits`
places; presence counts, not frequency. Learning is online: every coordinate has a learning rate of its own, and the
L1 penalty keeps most weights at zero, so that the model is a small list of places and weights, which is broadcast.

The learner sees at most `sample` labelled documents, the first in the order of a hash, `passes` times. Features are
made in parallel; one task updates the weights, holding one batch of rows at a time. Scoring sums weights over whole
texts. A text without words gets the score of the bias alone; without any labelled row all weights are zero and the
score is 0.5. A document labelled several times is toxic if any label says so. A repeated row gives a repeated
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.llm.language_id import normalised
from tallylake.llm.staging import staged

_LEFT, _RIGHT, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(text: str | None, bits: int) -> np.ndarray:
    """The places of all features of a text, repeats included; place 0 is the bias."""
    words = normalised(text).split()
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)
    left, right = h * _LEFT, h * _RIGHT
    mixed = np.concatenate((left, left[:-1] ^ right[1:], (left[:-2] ^ right[2:]) * _SKIP))
    mixed ^= mixed >> np.uint64(31)
    mixed *= _RIGHT
    return (mixed >> np.uint64(64 - bits)).astype(np.int64) | 1


class Learner:
    def __init__(self, bits: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.gradients = np.zeros(1 << bits)
        self.squares = np.zeros(1 << bits)

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, n = self.gradients[places], self.squares[places]
        dense = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, dense)

    def update(self, places: np.ndarray, label: int) -> None:
        """`places` are distinct."""
        weights = self.weights(places)
        error = 1 / (1 + np.exp(-np.clip(weights.sum(), -30, 30))) - label
        n = self.squares[places]
        rate = (np.sqrt(n + error * error) - np.sqrt(n)) / self.alpha
        self.gradients[places] += error - rate * weights
        self.squares[places] = n + error * error

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        weights = self.weights(np.arange(len(self.gradients)))
        used = np.flatnonzero(weights)
        return used, weights[used]


def learn(
    docs: DataFrame, labels: DataFrame, sample: int = 12_000, passes: int = 2, bits: int = 20,
    alpha: float = 1.0, beta: float = 1.0, l1: float = 3.0, l2: float = 1.0,
) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights from `labels` (doc_id, toxic) and the texts of `docs`."""
    marked = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    known = docs.select("doc_id").join(marked, "doc_id").dropDuplicates(["doc_id"])
    chosen = staged(known.withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(sample), "toxic-sample")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = (np.append(np.unique(features(t, bits)), 0).astype(np.int32) for t in batch.column("text").to_pylist())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "place": batch.column("place"), "toxic": batch.column("toxic"),
                "places": pa.array([p.tobytes() for p in made], pa.binary()),
            })

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(bits, alpha, beta, l1, l2)
        for batch in batches:
            for places, label in zip(batch.column("places").to_pylist(), batch.column("toxic").to_pylist()):
                learner.update(np.frombuffer(places, np.int32), int(label > 0))
        used, weights = learner.model()
        yield pa.record_batch({"at": pa.array(used, pa.int64()), "weight": pa.array(weights, pa.float64())})

    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen.withColumn("toxic", F.col("toxic").cast("long"))), "doc_id")
        .mapInArrow(extract, "doc_id long, place long, toxic long, places binary")
        .dropDuplicates(["doc_id"])
        .withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(passes))))
        .repartition(1)
        .sortWithinPartitions("turn", "place", "doc_id")
    )
    model = rows.mapInArrow(fit, "at long, weight double").toArrow()  # at most 2^bits rows
    return model["at"].to_numpy(), model["weight"].to_numpy()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bits: int = 20, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted): one row for each row of `docs`."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, values = held.value
        weights = np.zeros(1 << bits)
        weights[used] = values
        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                places = features(text, bits)
                places = np.unique(places[weights[places] != 0])
                total = weights[0] + weights[places].sum()
                scores.append(float(1 / (1 + np.exp(-np.clip(total, -30, 30)))))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "score": pa.array(scores, pa.float64()),
                "predicted": pa.array([int(s >= threshold) for s in scores], pa.int32()),
            })

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, score double, predicted int")
