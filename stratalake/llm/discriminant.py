"""Quality classifier: regularised quadratic discriminant over document statistics.

A text becomes a short vector of transformed statistics (logarithms of sizes,
square roots of shares).  For each class the labelled documents give a mean and a
covariance, from sums that Spark adds up over all of them.  Each covariance is
shrunk towards the pooled one and towards its own diagonal, and factored once
(Cholesky); the score is the logistic of the difference of the class
log-densities, half the squared Mahalanobis distances and the log-determinants,
plus the log-odds of the classes.

The vectors are made in one pass over the whole texts and written once; fitting
and scoring read them.  Only the sums, some 150 numbers, reach the driver.

NULL, empty and blank texts have the vector of a text without words and get a
score like others.  A document with several labels is good if all say so.  Labels
without id or value are left out; with labels of fewer than two classes the
score is their share, or 0.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import append_by_batch, column, utf8
from stratalake.session import staged

STATISTICS = (
    "words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "exclamations",
    "digits", "variety", "stops", "longest",
)
# Weight of the pooled covariance, and of the diagonal, in a class covariance.
TO_POOLED = 0.1
TO_DIAGONAL = 0.05
# Least standard deviation of a statistic, against statistics that never vary in a class.
LEAST_SPREAD = 0.05
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def statistics(text: bytes) -> list[float]:
    """The vector of a text."""
    words = text.split()
    count = len(words)
    n = max(1, count)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256)
    letters = max(1, seen[65:91].sum() + seen[97:123].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = max(1, count - 2)
    distinct = len(set(zip(words, words[1:], words[2:]))) if count > 2 else windows
    return [
        math.log1p(count),
        math.log1p(sum(map(len, words)) / n),
        math.sqrt(seen[_SYMBOLS].sum() / n),
        math.sqrt(1 - len(set(lines)) / len(lines)) if lines else 0.0,
        math.sqrt(1 - distinct / windows),
        math.sqrt(seen[65:91].sum() / letters),
        math.sqrt(seen[33] / n),
        math.sqrt(seen[48:58].sum() / max(1, len(text))),
        math.log1p(len(set(words))) / math.log1p(n + 1),
        math.sqrt(seen[46] / n),
        math.log1p(max(map(len, words), default=0)),
    ]


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, x): the vector of each row's whole text."""
    plain = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text"))
    return append_by_batch(plain, "x", T.ArrayType(T.DoubleType()),
                           lambda batch: [statistics(t) for t in utf8(batch, "text")]).drop("text")


def class_sums(vectors: DataFrame, labels: DataFrame, label_col: str) -> dict[int, tuple]:
    """(count, sum, sum of products) of the labelled vectors, by label."""
    size = len(STATISTICS)
    known = labels.select(F.col("doc_id"), column(label_col).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"))
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = vectors.join(known, "doc_id").groupBy("y").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("x")[i]) for i in range(size)]).alias("first"),
        F.array(*[F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in pairs]).alias("second"),
    ).where("y in (0, 1)").collect()
    found = {}
    for row in sums:
        second = np.zeros((size, size))
        for (i, j), value in zip(pairs, row["second"]):
            second[i, j] = second[j, i] = value
        found[row["y"]] = (row["n"], np.array(row["first"]), second)
    return found


def discriminant(sums: dict[int, tuple]) -> dict | None:
    """Means, inverse Cholesky factors and constants of both classes; None without both."""
    if set(sums) != {0, 1}:
        return None
    raw, total = {}, 0
    for y, (n, first, second) in sums.items():
        mean = first / n
        raw[y] = (n, mean, second / n - np.outer(mean, mean))
        total += n
    pooled = sum(n * cov for n, _, cov in raw.values()) / total
    model = {}
    for y, (n, mean, cov) in raw.items():
        # The smaller the class, the more it leans on both.
        shrink = TO_POOLED + (1 - TO_POOLED) * len(mean) / (len(mean) + n)
        cov = (1 - shrink) * cov + shrink * pooled
        cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov))
        factor = np.linalg.cholesky(cov + LEAST_SPREAD ** 2 * np.eye(len(mean)))
        model[y] = (mean, np.linalg.inv(factor),
                    math.log(n / total) - float(np.log(np.diag(factor)).sum()))
    return model


def log_density(x: np.ndarray, mean: np.ndarray, inverse: np.ndarray, constant: float) -> np.ndarray:
    """Class log-density, but for what the classes share."""
    whitened = (x - mean) @ inverse.T
    return constant - 0.5 * (whitened ** 2).sum(axis=1)


def score_quality(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", label_id_col: str = "doc_id",
) -> DataFrame:
    """(doc_id, x, score): the probability of label 1 for each whole text."""
    vectors = staged(with_statistics(docs, id_col, text_col), "statistics")
    own = labels.select(column(label_id_col).alias("doc_id"), column(label_col).alias(label_col))
    sums = class_sums(vectors, own, label_col)
    model = discriminant(sums)
    if model is None:
        return vectors.withColumn("score", F.lit(float(1 in sums)))

    def run(batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        x = flat.reshape(-1, len(STATISTICS))
        odds = log_density(x, *model[1]) - log_density(x, *model[0])
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))

    return append_by_batch(vectors, "score", T.DoubleType(), run)
