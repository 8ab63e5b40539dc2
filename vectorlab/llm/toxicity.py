"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its distinct words, their stems (the first STEM bytes of longer words), pairs of neighbours and
pairs around one word, hashed to DIMENSIONS.
Learning: per-coordinate FTRL-proximal with L1, over at most EXAMPLES labelled rows (those with the smallest
hash of their id, so the same at any partitioning), EPOCHS times in one task whose input that bound limits.
L1 leaves a few thousand weights, at most DIMENSIONS, which are broadcast to score all texts where they are read.

Labels: rows without an id or a label are left out; of several for one id the highest counts. A text without
words gets the score of the bias alone. Without labelled rows of both kinds every score is the share of toxic labels (0 if there
are none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

DIMENSIONS = 1 << 20
STEM = 5
EXAMPLES, EPOCHS = 20_000, 2
ALPHA, BETA, L1, L2 = 0.1, 1.0, 1.0, 1.0
THRESHOLD = 0.3
#: A-Z to lower case; every other ASCII byte that is no digit or letter becomes a space.
WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
PAIR, SKIP, MIX = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x27D4EB2F)


def features(data: bytes) -> np.ndarray:
    """Distinct hashed features of a UTF-8 text; 0 is kept for the bias."""
    words = data.translate(WORDS).split()
    h = np.fromiter(map(xxhash.xxh32_intdigest, words), np.uint32, len(words))
    pairs, skips = (h[:-1] * PAIR ^ h[1:]) * MIX, (h[:-2] * SKIP ^ h[2:]) * MIX
    stems = np.fromiter((xxhash.xxh32_intdigest(w[:STEM], 1) for w in words if len(w) > STEM), np.uint32)
    every = np.concatenate([h, stems, pairs ^ pairs >> np.uint32(15), skips ^ skips >> np.uint32(13)])
    return np.unique(every % np.uint32(DIMENSIONS - 1)) + 1


class Ftrl:
    """Learner with one step size per coordinate; weights follow from z and n."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.z, self.n = np.zeros(dimensions), np.zeros(dimensions)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient * gradient


def _fit(batches: Iterator[pa.RecordBatch], epochs: int) -> Iterator[pa.RecordBatch]:
    labels, sizes, blocks = [], [0], []
    for batch in batches:
        found = [np.append(features(data), 0).astype(np.int32) for data in C.byte_texts(batch.column(0))]
        labels += batch.column(1).to_pylist()
        sizes += [len(f) for f in found]
        blocks += [np.concatenate(found)] if found else []
    toxic = sum(labels)
    if 0 < toxic < len(labels):
        learner, every, ends = Ftrl(), np.concatenate(blocks), np.cumsum(sizes).tolist()
        blocks.clear()
        for _ in range(epochs):
            for label, begin, end in zip(labels, ends, ends[1:]):
                learner.learn(every[begin:end], label)
        w = learner.weights(slice(None))
    else:
        w = np.zeros(DIMENSIONS)
        w[0] = 35.0 if toxic else -35.0
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "w"])


def examples(labels: DataFrame, most: int, doc_id: str, label: str, training: Column | None) -> DataFrame:
    """(id, toxic) of at most `most` labelled ids, by smallest hash."""
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    if training is not None:
        known = known.where(training)
    known = known.groupBy(F.col(doc_id).alias("id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    return known.orderBy(F.xxhash64("id"), "id").limit(most)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
        training: Column | None = None, most: int = EXAMPLES, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Sparse weights {at, w}. training: condition over labels for the rows that may be learned from."""
    chosen = examples(labels, most, doc_id, label, training)
    rows = docs.select(F.col(doc_id).alias("id"), C.text_bytes(text).alias("data")).join(F.broadcast(chosen), "id")
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", F.xxhash64("data"))
    found = rows.select("data", "toxic").mapInArrow(lambda batches: _fit(batches, epochs), "at bigint, w double").toArrow()
    if not found.num_rows:  # no labels at all
        return {"at": np.array([0]), "w": np.array([-35.0])}
    return {"at": found["at"].to_numpy(), "w": found["w"].to_numpy()}


def score(docs: DataFrame, weights: dict[str, np.ndarray], text: str = "text") -> Column:
    """Column of scores from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    dense: list[np.ndarray] = []

    @F.arrow_udf(T.DoubleType())
    def scores(texts: pa.Array) -> pa.Array:
        if not dense:
            w = np.zeros(DIMENSIONS)
            w[sent.value["at"]] = sent.value["w"]
            dense.append(w)
        w = dense[0]
        total = np.array([w[0] + w[features(data)].sum() for data in C.byte_texts(texts)])
        return pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    return scores(C.text_bytes(text))


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; false for null ids."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    weights = fit(docs, labels, training=~is_held_out())
    scored = docs.select("doc_id", is_held_out().alias("held_out"), score(docs, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    weights = fit(docs, labels, training=~is_held_out())
    return docs.where(score(docs, weights) < threshold)
