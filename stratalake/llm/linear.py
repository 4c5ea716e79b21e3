"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes.

A text's features are the hashed 5- and 7-grams of its bytes, A-Z lowered, each
present or not.  Toxic texts count twice in training, as there are few.  Every
feature is scaled by the log-count ratio of naive Bayes, log((1 + toxic texts with
it) / toxic texts) against the same of other texts, the vector gets unit length, and
logistic regression with a quadratic penalty is trained on it by gradient steps.

Labels are used up to ``max_labels`` documents, those with the smallest hash of
their id among labels that have a document, so the sample is the same at any
parallelism and its ids may be handed to every task.  Features are made where the
texts are; the one task that trains holds only their numbers and values, 8 bytes for
each, of ``max_numbers`` features in all.  Scoring is one pass over the whole texts
with no shuffle: a task holds the weights, 8 bytes for each of 2^20 features.

A NULL or empty text has no features and gets the score of the intercept.  A
document with several labels counts as toxic if one says so; labels without id
or value are left out.  With labels of one class only, or none, the score is
that share, or 0.  Columns besides id and text are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import append_by_batch, column, fresh, smaller, utf8

BITS = 20
ORDERS = (5, 7)
# Bounds of the sample that the model is learnt from: documents, and their feature numbers of eight bytes.
MAX_LABELS = 6_000
MAX_NUMBERS = 1 << 26
# Feature numbers that a step of the training takes at once.
CHUNK = 1 << 22
PENALTY = 1e-5
STEPS = 100
THRESHOLD = 0.3
# Features whose log-count ratio is nearer to zero say little; they weigh nothing.
LEAST_RATIO = 0.5
# Bytes of text that are hashed at a time.
PIECE = 1 << 20

_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


def ngram_ids(text: bytes) -> np.ndarray:
    """Sorted feature numbers present in a text."""
    found = np.zeros(1 << BITS, bool) if len(text) > 20_000 else None
    some = []
    for start in range(0, max(1, len(text)), PIECE):
        # Pieces overlap, so no n-gram is lost between them.
        piece = _LOWER[np.frombuffer(text[start:start + PIECE + max(ORDERS) - 1], np.uint8)]
        codes = piece.astype(np.uint64)
        gram = codes
        for order in range(2, max(ORDERS) + 1):
            gram = (gram[:-1] << np.uint64(8)) | codes[order - 1:] if len(gram) > 1 else gram[:0]
            if order in ORDERS and len(gram):
                mixed = (gram + np.uint64(order << 56)) * np.uint64(0x9E3779B97F4A7C15)
                ids = (mixed >> np.uint64(64 - BITS)).astype(np.int32)
                if found is None:
                    some.append(ids)
                else:
                    found[ids] = True
    if found is not None:
        return np.flatnonzero(found).astype(np.int32)
    return np.unique(np.concatenate(some)) if some else np.empty(0, np.int32)


def train(rows: list[np.ndarray], labels: list[int], penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """Weight of each feature, log-count ratio included, and the intercept at the end; rows as of ``ngram_ids``."""
    size = 1 << BITS
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        weights = np.zeros(size + 1)
        weights[-1] = np.log((share + 1e-9) / (1 - share + 1e-9))
        return weights
    one, every = np.zeros(size), np.zeros(size)
    for row, label in zip(rows, y):
        every[row] += 1
        one[row] += label
    zero = every - one
    ratio = np.log((1 + one) / (1 + y.sum())) - np.log((1 + zero) / (1 + (1 - y).sum()))
    ratio[np.abs(ratio) < LEAST_RATIO] = 0
    # Only telling features are kept, four bytes for each and four for its value; ``rows`` is emptied on the way.
    parts, values = [], []
    for at, row in enumerate(rows):
        told = row[ratio[row] != 0]
        value = ratio[told]
        parts.append(told)
        values.append((value / max(float(np.sqrt(value @ value)), 1e-9)).astype(np.float32))
        rows[at] = None
    # Documents in chunks of so many feature numbers, so what a step computes stays small.
    sizes = np.array([len(part) for part in parts])
    ends = np.searchsorted(np.cumsum(sizes), np.arange(CHUNK, sizes.sum() + CHUNK, CHUNK), side="left") + 1
    ends = np.unique(np.minimum(np.append(ends, len(parts)), len(parts)))
    chunks = []
    for start, end in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
        chunks.append((slice(start, end), sizes[start:end], np.concatenate(parts[start:end]), np.concatenate(values[start:end])))
        parts[start:end] = values[start:end] = [None] * (end - start)
    # Adam over all rows: features differ in scale by orders of magnitude.
    weights, bias = np.zeros(size), float(np.log(y.mean() / (1 - y.mean())))
    first, second, low, high = np.zeros(size), np.zeros(size), 0.0, 0.0
    score = np.zeros(len(y))
    for step in range(1, steps + 1):
        for rows_of, counts, columns, value in chunks:
            owner = np.repeat(np.arange(len(counts)), counts)
            score[rows_of] = np.bincount(owner, weights[columns] * value, len(counts))
        error = (1 / (1 + np.exp(-np.clip(score + bias, -40, 40))) - y) * (1 + y) / len(y)
        slope = penalty * weights
        for rows_of, counts, columns, value in chunks:
            slope += np.bincount(columns, np.repeat(error[rows_of], counts) * value, size)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        low, high = 0.9 * low + 0.1 * error.sum(), 0.99 * high + 0.01 * error.sum() ** 2
        rate = 0.1 * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
        weights -= rate * first / (np.sqrt(second) + 1e-8)
        bias -= rate * low / (np.sqrt(high) + 1e-8)
    return np.concatenate([ratio, weights, [bias]])


def probability(text: bytes, model: np.ndarray) -> float:
    ids = ngram_ids(text)
    if len(model) == (1 << BITS) + 1 or not len(ids):
        return float(1 / (1 + np.exp(-model[-1])))
    values = model[ids]
    norm = max(float(np.sqrt(values @ values)), 1e-9)
    score = float(values @ model[(1 << BITS) + ids]) / norm + model[-1]
    return float(1 / (1 + np.exp(-np.clip(score, -40, 40))))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_labels: int = MAX_LABELS, max_numbers: int = MAX_NUMBERS) -> np.ndarray:
    """Model from labelled documents; training runs in one task on the bounded sample.

    The sample takes documents in the order of a hash of their ids, up to ``max_labels``, and as many
    of them as have up to ``max_numbers`` features together, the first one in any case.
    """
    plain = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    known = (
        labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull())
        .groupBy("id").agg(F.max("y").alias("y"))
        .join(plain.select("id"), "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id").limit(max_labels)
    )
    picked = plain.join(F.broadcast(known), "id")
    # A document of many rows counts once, with its least text.
    once = picked.groupBy("id", "y").agg(F.min("text").alias("text"))
    featured = append_by_batch(
        once, "features", T.BinaryType(), lambda batch: [ngram_ids(t).tobytes() for t in utf8(batch, "text")])

    def learn(batches):
        rows, ys, held = [], [], 0
        for batch in smaller(batches, 100):
            for features, label in zip(utf8(batch, "features"), batch.column(batch.schema.get_field_index("y")).to_pylist()):
                held += len(features) // 4
                if held > max_numbers and rows:
                    break
                rows.append(np.frombuffer(features, np.int32))
                ys.append(label)
            if held > max_numbers:
                break
        model = train(rows, ys).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([model.tobytes()], pa.binary())], names=["model"])

    # An exchange, not coalesce, so that features are not made in the task that trains.
    dealt = featured.select("y", "features", F.xxhash64("id").alias("h"), "id").repartition(1).sortWithinPartitions("h", "id")
    made = dealt.select("y", "features").mapInArrow(learn, "model binary").first()
    return np.frombuffer(made["model"], np.float32) if made else train([], [])


def score(docs: DataFrame, model: np.ndarray, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text."""
    handed = docs.sparkSession.sparkContext.broadcast(model)
    text = fresh(docs, "whole_text")

    def run(batch: pa.RecordBatch) -> list[float]:
        weights = handed.value
        return [probability(t, weights) for t in utf8(batch, text)]

    scored = append_by_batch(docs.withColumn(text, column(text_col).cast("string")), name, T.DoubleType(), run)
    return scored.drop(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Documents that score below the threshold, with their columns; documents without id stay in."""
    name = fresh(docs, "score")
    scored = score(docs, fit(docs, labels, **options), name, options.get("text_col", "text"))
    return scored.where(column(name) < threshold).drop(name)
