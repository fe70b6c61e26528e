"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each document becomes a vector of counts and shares, logarithmed so that they are near to normal. Each of the two classes
has a mean and a covariance from all labelled documents that are not held out (sums and sums of products, aggregated by
Spark); the covariance is shrunk towards its diagonal, and its variances towards those of both classes. The score is the
posterior probability of class 1: the difference of the classes' log densities, from Mahalanobis distances by the
classes' Cholesky factors, which are computed once, plus that of the classes' shares.

The texts are read once: the vectors are written, and fit and scores read those.

Defined results: null and empty texts have a vector like any other and get a score; null labels and ids are not learned
from; of several labels of one id each counts; documents that share an id are scored one by one; with labels of one class
only the score is 1 or 0, with none at all it is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcast.llm.common import held_out, written
from clickcast.llm.docstats import count

SHRINKAGE = 0.1
VARIANCE_SHRINKAGE = 0.1
FLOOR = 1e-4
THRESHOLD = 0.3
NEUTRAL = 20
SIZE = 13


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text, ``SIZE`` of them.

    Every text is taken to have ``NEUTRAL`` ordinary words more than it has, of five letters and all different, so that a
    few words alone cannot make a share extreme.
    """
    c = count(text)
    words, lines, chars = c.n_words + NEUTRAL, c.n_lines + 1, c.word_chars + 5 * NEUTRAL
    share = lambda part, whole, least=0.01: log(part / whole + least)
    return [
        log(words),
        log(chars / words),
        share(c.n_symbols, words),
        share(c.n_digits, chars),
        share(c.n_upper + 0.2 * NEUTRAL, c.n_letters + 5 * NEUTRAL),
        share(c.n_letters + 4.85 * NEUTRAL, chars, 0.1),
        log(words / lines),
        share(c.n_stop_lines + 2, lines + 1, 0.1),
        log(words / (c.n_stops + 2)),
        share(c.n_distinct + NEUTRAL, words, 0.05),
        share(c.n_repeat_words, words, 0.05),
        share(c.n_dup_lines, lines + 2, 0.1),
        share(c.n_short + 0.4 * NEUTRAL, words, 0.05),
    ]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # A text at a time, so that long ones are not all held as Python objects.
        rows = np.array([statistics(t.as_py()) for t in batch.column(1)], np.float64).reshape(batch.num_rows, SIZE)
        offsets = pa.array(np.arange(0, SIZE * batch.num_rows + 1, SIZE), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, rows.ravel())], ["id", "x"])


def vectors(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """``id, x`` for every document, written."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(_vectors, f"id {kind}, x array<double>"), "quality-vectors")


@dataclass
class Discriminant:
    """Per class: share, mean and Cholesky factor of the covariance; no class where there were no labels."""

    shares: dict[int, float]
    means: dict[int, np.ndarray]
    factors: dict[int, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for each row of ``x``."""
        if len(self.shares) < 2:
            return np.full(len(x), float(next(iter(self.shares), 0.5)))
        density = {}
        for k, factor in self.factors.items():
            z = np.linalg.solve(factor, (x - self.means[k]).T)
            density[k] = log(self.shares[k]) - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(0)
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(vectors: DataFrame, labels: DataFrame, *, id_col="doc_id", label_col="quality") -> Discriminant:
    """From all labelled rows that are not held out."""
    labels = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("k")).filter("k in (0, 1)")
    rows = vectors.join(labels, F.col("id") == F.col("label_id")).filter(~held_out(F.col("id")))
    places = [(i, j) for i in range(SIZE) for j in range(i + 1)]
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(SIZE)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i, j in places]
    found = {r["k"]: r for r in rows.groupBy("k").agg(F.count("*").alias("n"), *sums, *products).collect()}
    total = sum(r["n"] for r in found.values())
    means, covariances = {}, {}
    for k, r in found.items():
        means[k] = np.array([r[f"s{i}"] for i in range(SIZE)]) / r["n"]
        square = np.zeros((SIZE, SIZE))
        for i, j in places:
            square[i, j] = square[j, i] = r[f"p{i}_{j}"] / r["n"]
        covariances[k] = square - np.outer(means[k], means[k])
    factors = {}
    for k, covariance in covariances.items():
        both = sum(found[c]["n"] * np.diag(covariances[c]) for c in covariances) / total
        own = (1 - SHRINKAGE) * covariance + SHRINKAGE * np.diag(np.diag(covariance))
        own = (1 - VARIANCE_SHRINKAGE) * own + VARIANCE_SHRINKAGE * np.diag(both)
        factors[k] = np.linalg.cholesky(own + FLOOR * np.eye(SIZE))
    return Discriminant({k: r["n"] / total for k, r in found.items()}, means, factors)


def _scored(model: Discriminant, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, SIZE)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x) if len(x) else [], pa.float64())], ["id", "score"])


def score(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """``id, score`` for each row of ``vectors``."""
    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "x").mapInArrow(lambda batches: _scored(model, batches), f"id {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", threshold=THRESHOLD) -> DataFrame:
    """Per document: id, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    made = vectors(docs, id_col=id_col, text_col=text_col)
    scored = score(made, fit(made, labels, id_col=id_col))
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", predicted.alias("predicted"))


def drop_low_quality(
    docs: DataFrame, labelled_docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", threshold=THRESHOLD
) -> DataFrame:
    """The documents with a score of ``threshold`` or more, with their own columns; learned from ``labelled_docs``."""
    model = fit(vectors(labelled_docs, id_col=id_col, text_col=text_col), labels, id_col=id_col)
    # The model is a few hundred numbers, so whole rows are filtered where they are and nothing is shuffled.
    def keep(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(t) for t in texts]).reshape(len(texts), SIZE)
        return pd.Series(model.score(rows) >= threshold)

    return docs.filter(F.pandas_udf(keep, "boolean")(F.col(text_col)))
