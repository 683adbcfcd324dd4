"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and L1 keeps those at zero that never earn a weight, so that what is sent to
the executors is a short list. Labelled texts become arrays of hashed features in parallel; the updates, which depend on
one another, then run over a bounded sample of those arrays. Scoring is a pass over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_id, materialize, texts

BITS = 20
#: Labelled documents that the weights are fit on, in expectation.
SAMPLE = 16_000
#: Features of all of them together, in expectation: 4 bytes each in the one task that learns. Beyond it, fewer rows are learned from.
MAX_FEATURES = 100_000_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
#: A marked document counts as so many others, as marks are few.
MARKED_WEIGHT = 3.0
#: Words of a text whose features are made at a time, and hashes that a worker remembers.
BLOCK, REMEMBERED = 1 << 18, 1 << 19

_BREAKS = bytes.maketrans(bytes(range(33)) + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\x7f", b" " * 66)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_hashes: dict[bytes, int] = {}


def features(text: bytes, bits: int = BITS) -> np.ndarray:
    """The distinct hashed features of a whole text: words (ASCII lower-cased, cut at ASCII punctuation), word pairs,
    and pairs that skip one word."""
    words = text.lower().translate(_BREAKS).split()
    found = []
    shift = np.uint64(64 - bits)
    for lo in range(0, len(words), BLOCK):
        block = words[lo : lo + BLOCK + 2]
        if len(_hashes) > REMEMBERED:
            _hashes.clear()
        for w in block:
            if w not in _hashes:
                _hashes[w] = xxhash.xxh64_intdigest(w)
        h = np.array([_hashes[w] for w in block], np.uint64)
        parts = [h * _A, (h[:-1] * _B) ^ (h[1:] * _C), (h[:-2] * _C) ^ (h[2:] * _A)]
        found.append(np.unique(np.concatenate([(p * _B) >> shift for p in parts])))
    if not found:
        return np.empty(0, np.int64)
    return (found[0] if len(found) == 1 else np.unique(np.concatenate(found))).astype(np.int64)


class Ftrl:
    """FTRL-proximal for logistic loss over sets of features; coordinate 0 past the features is the bias, without L1."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2, marked_weight: float = MARKED_WEIGHT):
        self.bias, self.alpha, self.beta, self.l2, self.marked_weight = 1 << bits, alpha, beta, l2, marked_weight
        self.z, self.n = np.zeros(self.bias + 1), np.zeros(self.bias + 1)
        self.l1 = np.full(self.bias + 1, l1)
        self.l1[self.bias] = 0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        over = np.maximum(np.abs(z) - self.l1[at], 0) * np.sign(z)
        return -over / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, self.bias)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        g *= self.marked_weight if label else 1.0
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(id, label, features) for about sample labelled rows at most, chosen by a hash of the id.

    Rows with crc32(id) mod 5 = 0 are held out. A document that any label row marks is marked; null labels don't count.
    Rows of docs that repeat an id are each learned from.
    """
    marks = labels.where(F.col(label_col).isNotNull() & (crc32_id(F.col(id_col)) % 5 != 0)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    marks = materialize(marks, "marks")
    part = min(1.0, sample / max(1, marks.count()))
    chosen = materialize(marks.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(part * (1 << 20))), "chosen")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t) for t in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int64()))], names=["id", "label", "features"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", "label", "text")  # about sample rows of 12 bytes
    return rows.mapInArrow(make, f"id {rows.schema['id'].dataType.simpleString()}, label int, features array<long>")


def fit(sampled: DataFrame, epochs: int = EPOCHS, bits: int = BITS, max_features: int = MAX_FEATURES) -> np.ndarray:
    """Weights by feature, the bias last, from (id, label, features) rows: the updates run in one task over the bounded
    sample, in an order that a hash of the id sets. Rows are bounded by labelled_sample, their features by max_features.
    No rows give weights of zero."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Ftrl(bits), []
        for b in batches:
            at = b.column(1)
            values, ends = at.values.to_numpy(), at.offsets.to_numpy()
            seen += [(values[s:e].astype(np.int32), y) for s, e, y in zip(ends[:-1], ends[1:], b.column(0).to_pylist(), strict=True)]
        for _ in range(epochs):
            for x, y in seen:
                model.learn(x, y)
        w = model.weights(np.arange(model.bias + 1))
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(w[used])], names=["feature", "weight"])

    made = materialize(sampled, "features")
    total = made.agg(F.sum(F.size("features").cast("long"))).first()[0] or 0
    if total > max_features:  # very long texts, or ids that many rows repeat
        made = made.where(F.pmod(F.xxhash64("id", "features"), F.lit(1 << 20)) < int(max_features / total * (1 << 20)))
    one = made.repartition(1).sortWithinPartitions(F.xxhash64("id", F.lit(7)), "id", "features").select("label", "features")
    weights = np.zeros((1 << bits) + 1)
    for row in one.mapInArrow(learn, "feature long, weight double").collect():  # those that L1 leaves, 2^bits at most
        weights[row["feature"]] = row["weight"]
    return weights


def score_texts(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, score (0 to 1), predicted (1 from 0.5).

    A null or empty text has the score of the bias alone. Null ids and repeated rows are carried through. Other columns
    are not looked at; no rows give no rows.
    """
    bits = (len(weights) - 1).bit_length() - 1
    used = np.flatnonzero(weights)
    sparse = docs.sparkSession.sparkContext.broadcast((used, weights[used]))  # 16 MB at most, mostly far less

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros((1 << bits) + 1)
        w[sparse.value[0]] = sparse.value[1]
        for b in batches:
            logit = np.array([w[features(t, bits)].sum() + w[-1] for t in texts(b.column(1))])
            p = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], names=["id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, score double, predicted int").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Learn from the labels that are not held out, score all documents; see score_texts."""
    return score_texts(docs, fit(labelled_sample(docs, labels, id_col, text_col, label_col, sample)), id_col, text_col)
