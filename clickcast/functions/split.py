"""Train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def random_split(df: DataFrame, train: float = 0.9, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Bernoulli sample. Which rows fall where depends on how the input is partitioned."""
    left, right = df.randomSplit([train, 1.0 - train], seed)
    return left, right


def hash_tenth(key: str, digits: int = 0) -> Column:
    """A tenth, 0 to 9, from eight hex digits of the md5 of ``key``. ``digits`` 0 to 3 picks which eight."""
    digest = F.md5(F.col(key).cast("string"))
    return F.conv(F.substring(digest, 1 + 8 * digits, 8), 16, 10).cast("bigint") % 10


def in_first_tenths(key: str, tenths: int, digits: int = 0) -> Column:
    """Whether a row is on the larger side of ``hash_split``."""
    return hash_tenth(key, digits) < tenths


def hash_split(df: DataFrame, key: str, train_tenths: int = 9, digits: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split on the md5 of a key: the same rows on every run, for any partitioning, without a sort.

    Splits with different ``digits`` are independent of each other.
    """
    tenth = hash_tenth(key, digits)
    return df.filter(tenth < train_tenths), df.filter(tenth >= train_tenths)
