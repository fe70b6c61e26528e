"""Sinks."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickcast.sources.read import TIMESTAMP_FORMAT


def write_clicks_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw click columns to CSV with a header."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Parquet, in ``files`` files if given; otherwise one per task, so the file count follows the data."""
    if files is not None:
        df = df.repartition(files)
    df.write.mode(mode).parquet(path)


def scalar_predictions(df: DataFrame) -> DataFrame:
    """Predictions without vector columns, plus ``score``, the probability of label 1."""
    kept = [f.name for f in df.schema.fields if not isinstance(f.dataType, VectorUDT)]
    score = vector_to_array("probability")[1] if "probability" in df.columns else F.col("prediction")
    return df.select(*kept, score.alias("score"))


def write_predictions_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """``label, score, prediction`` as CSV; CSV cannot hold the vector columns."""
    scalar_predictions(df).select("label", "score", "prediction").write.mode(mode).option("header", True).csv(path)


def write_metric(spark, value: float, path: str) -> None:
    """One value, as text and without a header, in a one-row CSV."""
    spark.createDataFrame([(str(value),)], "value string").coalesce(1).write.mode("overwrite").csv(path)
