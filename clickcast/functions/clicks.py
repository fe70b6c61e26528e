"""Row-wise steps from a raw click log to the columns the features need. All narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns dropped after the time parts are taken.
DROPPED = ("click_time", "attributed_time")


def add_time_parts(df: DataFrame, time: str = "click_time", minute: bool = False) -> DataFrame:
    """``hour`` (0-23) and ``day`` (of month, 1-31); ``minute`` on request."""
    parts = {"hour": F.hour(time), "day": F.dayofmonth(time)}
    if minute:
        parts["minute"] = F.minute(time)
    return df.withColumns(parts)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names the table lacks are ignored."""
    return df.drop(*names)


def prepare_clicks(df: DataFrame, minute: bool = False) -> DataFrame:
    """Time parts added, the time columns dropped and ``is_attributed`` renamed ``label``."""
    return drop_columns(add_time_parts(df, minute=minute), *DROPPED).withColumnRenamed("is_attributed", "label")


def show_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """Some ``n`` rows to look at: whichever Spark comes across first."""
    return df.limit(n)
