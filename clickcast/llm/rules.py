"""Quality rules: hard limits, then robust multivariate outliers per language and source.

A document fails the base rule if it is short or mostly repeats itself. The others become vectors of transformed
statistics. For each language and source the centre and covariance of the central part of the vectors are estimated by
the minimum covariance determinant: from medians and quartiles, concentration steps take the share ``COVERAGE`` with the
smallest Mahalanobis distances and estimate again, with the factor that makes the covariance of a central part that of
the whole for normal vectors. A document whose squared distance is beyond the ``CUTOFF`` quantile of the chi-squared
distribution is rejected. Length is no statistic here: a long document is no outlier.

Every step is a pair of aggregations over all documents, for all groups at once: a histogram of distances per group, from
which the limit of the central part follows, and sums and products of the vectors within it. No group is ever brought
together, so one group may hold most of the documents. Groups of fewer than ``LEAST_DOCS`` documents are measured
against the estimate over their whole language, all its sources included, and documents of a language that is thin even
then against the estimate over all documents, however few. So every document that passes the base rule is judged.

To all variances ``LEAST_DEVIATION`` squared is added, as in many groups most documents agree exactly in some statistic,
and a statistic without spread would reject every document that differs at all.

Defined results: null and empty texts have no words and fail the base rule; a null language or source is a value of its
own; ids may be null or repeated, each row is judged by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickcast.llm.common import in_pandas, written
from clickcast.llm.docstats import count

LEAST_WORDS, MOST_REPEATED = 50, (50, 100)
COVERAGE = 0.75
STEPS = 3
LEAST_DOCS = 200
LEAST_DEVIATION = 0.5
# The share of normal documents within the cutoff.
CUTOFF = 0.999
# Every text is taken to have so many ordinary words more, so that a few words cannot make a share extreme.
NEUTRAL = 20
# Bins of the logarithm of the squared distance.
BINS_PER_UNIT = 64
# The group of all documents; names of languages and sources are empty or begin otherwise.
ALL = "*"
SIZE = 6


def statistics(c) -> list[float]:
    """The transformed statistics from a text's counts."""
    words, lines, chars = c.n_words + NEUTRAL, c.n_lines + 3, c.word_chars + 5 * NEUTRAL
    return [
        log(chars / words),
        log(c.n_symbols / words + 0.02),
        log(c.n_dup_lines / lines + 0.25),
        log(c.n_repeat_words / words + 0.25),
        log(c.n_digits / chars + 0.02),
        log((c.n_letters + 5 * NEUTRAL) / chars + 0.1),
    ]


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = [count(t) for t in batch["text"]]
        made = {n: [getattr(c, n) for c in counts] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        yield pd.DataFrame({c: batch[c] for c in ("id", "lang", "source")} | made | {"x": [statistics(c) for c in counts]})


def chi2_quantile(share: float, size: int = SIZE) -> float:
    """The quantile of the chi-squared distribution, after Wilson and Hilferty."""
    spread = (2 / (9 * size)) ** 0.5
    return size * (1 - spread**2 + NormalDist().inv_cdf(share) * spread) ** 3


def chi2_share(x: float, size: int) -> float:
    """The share of the chi-squared distribution up to ``x``, by the series of the incomplete gamma function."""
    half, a = x / 2, size / 2
    term, total, n = 1 / a, 0.0, 0
    while term > 1e-15:
        total, n = total + term, n + 1
        term *= half / (a + n)
    return total * exp(a * log(half) - half - lgamma(a))


# What the covariance of the central part of normal vectors is multiplied by.
CONSISTENCY = COVERAGE / chi2_share(chi2_quantile(COVERAGE), SIZE + 2)


def _inverted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Means and inverse covariances, row by row, from sums and products."""
    for batch in batches:
        means, inverses = [], []
        for n, sums, products in zip(batch["n"], batch["sums"], batch["products"], strict=True):
            mean = np.array(sums) / n
            square = np.zeros((SIZE, SIZE))
            square[np.tril_indices(SIZE)] = np.array(products) / n
            square = CONSISTENCY * (square + np.tril(square, -1).T - np.outer(mean, mean))
            means.append(mean.tolist())
            inverses.append(np.linalg.inv(square + LEAST_DEVIATION**2 * np.eye(SIZE)).ravel().tolist())
        yield pd.DataFrame({"g": batch["g"], "mean": means, "inverse": inverses})


def _distance(x, mean, inverse):
    """The squared Mahalanobis distance as an expression."""
    d = [x[i] - mean[i] for i in range(SIZE)]
    return sum(d[i] * sum(inverse[i * SIZE + j] * d[j] for j in range(SIZE)) for i in range(SIZE))


def _limits(rows: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``g`` and, for each share, the bin of the distance (``b``) by which that share of the group is reached."""
    bins = rows.groupBy("g", "b").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("g").orderBy("b")
    running = bins.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("g")))
    return running.groupBy("g").agg(*(F.min(F.when(F.col("upto") >= F.col("all") * s, F.col("b"))).alias(c) for c, s in shares.items()))


def _with_distances(rows: DataFrame, models: DataFrame) -> DataFrame:
    """``rows`` of groups with a model, with ``d`` and its bin ``b``. The rows of a group may be many; models are few rows."""
    both = rows.join(models, "g").withColumn("d", _distance(F.col("x"), F.col("mean"), F.col("inverse")))
    return both.withColumn("b", F.floor(F.log(F.greatest("d", F.lit(1e-9))) * BINS_PER_UNIT)).drop("mean", "inverse")


def _models(rows: DataFrame, name: str) -> DataFrame:
    """``g, mean, inverse`` from the vectors of ``rows``."""
    x = F.col("x")
    places = [(i, j) for i in range(SIZE) for j in range(i + 1)]
    sums = [F.sum(x[i]) for i in range(SIZE)]
    products = [F.sum(x[i] * x[j]) for i, j in places]
    found = rows.groupBy("g").agg(F.count("*").alias("n"), F.array(*sums).alias("sums"), F.array(*products).alias("products"))
    return written(found.mapInPandas(_inverted, "g string, mean array<double>, inverse array<double>"), name)


def _starts(rows: DataFrame) -> DataFrame:
    """First models: medians, and spreads from quartiles."""
    quartiles = rows.groupBy("g").agg(
        *(F.percentile_approx(F.col("x")[i], [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i in range(SIZE))
    )
    variances = [((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 + LEAST_DEVIATION**2 for i in range(SIZE)]
    inverse = [1 / variances[i] if i == j else F.lit(0.0) for i in range(SIZE) for j in range(SIZE)]
    centre = F.array(*(F.col(f"q{i}")[1] for i in range(SIZE)))
    return written(quartiles.select("g", centre.alias("mean"), F.array(*inverse).alias("inverse")), "rules-start")


def judge(docs: DataFrame, *, id_col="doc_id", text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """Per document: id, the counts, ``base_failed``, ``distance`` and ``kept``.

    ``distance`` is squared, from the estimate of the language (and source); it is null where the base rule fails and
    where the language has no estimate of its own, so that ``kept`` follows the estimate over all documents.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text")
    )
    names = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    made = in_pandas(rows, _measured, f"lang string, source string, {names}, x array<double>")
    of, whole = MOST_REPEATED
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * whole > F.col("n_words") * of)
    made = written(made.withColumn("base_failed", failed), "rules-counts")

    # A group's name tells nulls from texts: null gives no text between the marks.
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    full = F.concat_ws("\x00", lang, F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    named = made.withColumns({"full": full, "whole": lang}).drop("lang", "source")
    sizes = named.filter("not base_failed").groupBy("full", "whole").agg(F.count("*").alias("size"))
    sizes = sizes.join(sizes.groupBy("whole").agg(F.sum("size").alias("of_whole")), "whole")
    g = F.when(F.col("size") >= LEAST_DOCS, F.col("full")).when(F.col("of_whole") >= LEAST_DOCS, F.col("whole")).otherwise(ALL)
    groups = written(sizes.select("full", g.alias("g")), "rules-groups")
    grouped = written(named.join(groups, "full", "left"), "rules-grouped")
    # A document is part of every estimate that its source, its language or all documents need.
    parts = F.explode(F.array("full", "whole", F.lit(ALL))).alias("g")
    rows = grouped.filter("not base_failed").select(parts, "x").join(groups.select("g").distinct(), "g", "left_semi")
    rows = written(rows, "rules-vectors")
    models = _starts(rows)
    for step in range(STEPS):
        near = _with_distances(rows, models)
        near = near.join(_limits(near, {"most": COVERAGE}), "g").filter(F.col("b") <= F.col("most"))
        models = _models(near, f"rules-step{step}")
    judged = grouped.join(models, "g", "left").withColumn("distance", _distance(F.col("x"), F.col("mean"), F.col("inverse")))
    distance = F.when(~F.col("base_failed"), F.col("distance"))
    kept = ~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= chi2_quantile(CUTOFF))
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.when(F.col("g") != ALL, distance).alias("distance"), kept.alias("kept"),
    )
