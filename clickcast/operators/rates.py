"""Categories as numbers that a tree can split well: the smoothed rate of label 1 among a category label's rows.

Ordered by that rate, an ordered split finds the best of all subsets of labels for two classes, so a shallow tree over one
number per column does what takes a feature per label otherwise, however many labels there are. A rate is
``(P + m * r) / (n + m)`` for n rows, P of them positive, the rate r of all rows and a weight ``m``; null and unseen labels
have r.

A training row must not see its own label in its features: it gets the rates of the rows in other folds than its own, r
included. The fold is taken from the md5 of a key, so it does not depend on partitioning. Other rows get the rates of all
training rows.

The rates are a table of a row per label and fold; nothing of it reaches the driver. They are looked up as indices are: by a
broadcast for a column with few labels, else by a spread join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.functions.split import hash_tenth
from clickcast.operators.counts import GROUPS
from clickcast.operators.encode import CATEGORIES, WIDE_LABELS, dense_fields, number_column
from clickcast.operators.joins import HOT_ROWS, frequent_keys, spread_join
from clickcast.session import checkpointed, stored

FOLDS = 5
WEIGHT = 20.0
# The fold number under which the rates of all rows stand.
ALL = -1


def fold_of(key: str) -> Column:
    """A row's fold, 0 to 4, from the md5 of ``key``: other digits than the splits use."""
    return F.floor(hash_tenth(key, 2) / (10 // FOLDS)).cast("int")


def rate_sums(df: DataFrame, columns: Sequence[str], fold: Column, label: str = "label") -> DataFrame:
    """``column, label, fold, n, positive`` for every non-null value of every column, in one pass and one aggregation.

    The rows of the column ``""`` are those of all clicks.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    whole = F.struct(F.lit("").alias("column"), F.lit("").alias("value"))
    long = df.select(fold.alias("fold"), F.col(label).alias("_y"), F.inline(F.array(whole, *pairs)))
    sums = long.filter("value is not null").groupBy("column", F.col("value").alias("label"), "fold")
    return sums.agg(F.count("*").alias("n"), F.count_if(F.col("_y") > 0.5).alias("positive"))


@dataclass(frozen=True)
class RateEncoder:
    """``table``: ``column, label, fold, rate``, fold ALL for all rows; ``base``: ``fold, rate`` of all clicks outside it."""

    table: DataFrame
    base: DataFrame
    categories: Sequence[str] = CATEGORIES
    numeric: Sequence[str] = tuple(GROUPS)

    @cached_property
    def sizes(self) -> dict[str, int]:
        """Labels per column: one number each."""
        counts = self.table.filter(F.col("fold") == ALL).groupBy("column").agg(F.count("*").alias("n"))
        return {r["column"]: r["n"] for r in counts.collect()}

    def add_rates(self, df: DataFrame, fold: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
        """``<column>_Rate`` for each category: out of ``fold`` for training rows, of all training rows without it."""
        base = {r["fold"]: r["rate"] for r in self.base.collect()}
        rows = df.withColumn("_at", F.lit(ALL) if fold is None else fold)
        none = F.coalesce(*(F.when(F.col("_at") == f, F.lit(r)) for f, r in base.items()), F.lit(base.get(ALL, 0.0)))
        for c in self.categories:
            rates = self.table.filter(F.col("column") == c).select(
                F.col("label").alias("_label"), F.col("fold").alias("_at"), F.col("rate").alias(f"{c}_Rate")
            )
            rows = rows.withColumn("_label", F.col(c).cast("string"))
            if self.sizes.get(c, 0) > WIDE_LABELS:
                counted = rows.filter("_label is not null").groupBy("_label", "_at").agg(F.count("*").alias("n"))
                hot = checkpointed(frequent_keys(counted, "n", hot_rows).drop("n").join(rates, ["_label", "_at"], "left"))
                rows = spread_join(rows, rates, hot, ["_label", "_at"])
            else:
                rows = rows.join(F.broadcast(rates), ["_label", "_at"], "left")
            rows = rows.withColumn(f"{c}_Rate", F.coalesce(f"{c}_Rate", none))
        return rows.select(*df.columns, *(f"{c}_Rate" for c in self.categories))

    def transform(self, df: DataFrame, fold: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
        """``add_rates`` and ``rate_features``: the rates and the numeric columns, as the fields of a dense vector."""
        rows = self.add_rates(df, fold, hot_rows)
        return rows.withColumn(
            "rate_features", dense_fields([*(F.col(f"{c}_Rate") for c in self.categories), *map(number_column, self.numeric)])
        )

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").partitionBy("column").parquet(f"{path}/labels")
        self.base.coalesce(1).write.mode("overwrite").parquet(f"{path}/base")

    @staticmethod
    def load(spark: SparkSession, path: str, categories: Sequence[str] = CATEGORIES, numeric=tuple(GROUPS)) -> RateEncoder:
        return RateEncoder(spark.read.parquet(f"{path}/labels"), spark.read.parquet(f"{path}/base"), categories, numeric)


def fit_rates(
    df: DataFrame,
    fold: Column,
    categories: Sequence[str] = CATEGORIES,
    numeric: Sequence[str] = tuple(GROUPS),
    label: str = "label",
    weight: float = WEIGHT,
) -> RateEncoder:
    """The rates of the categories of ``df``, by fold and over all of it, written as a table."""
    sums = stored(rate_sums(df, categories, fold, label), "rate-sums")
    whole = sums.groupBy("column", "label").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    # Per fold what the other folds have, and everything under ALL.
    of_fold = sums.join(whole.withColumnsRenamed({"n": "_n", "positive": "_p"}), ["column", "label"])
    others = of_fold.select("column", "label", "fold", (F.col("_n") - F.col("n")).alias("n"), (F.col("_p") - F.col("positive")).alias("positive"))
    both = others.unionByName(whole.withColumn("fold", F.lit(ALL)))
    # One row per fold.
    base = both.filter(F.col("column") == "").select("fold", (F.col("positive") / F.greatest(F.col("n"), F.lit(1))).alias("rate"))
    base = checkpointed(base.coalesce(1))
    known = both.filter(F.col("column") != "").join(F.broadcast(base.withColumnRenamed("rate", "_base")), "fold")
    rate = (F.col("positive") + weight * F.col("_base")) / (F.col("n") + weight)
    return RateEncoder(stored(known.select("column", "label", "fold", rate.alias("rate")), "rates"), base, tuple(categories), tuple(numeric))
