"""Scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickcast.session import stored

# Written and read with microseconds, so a round trip keeps click_time whole.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_clicks_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A click log in CSV with a header.

    Without ``schema`` the types are inferred, which costs one more pass over the file and types an all-null
    ``attributed_time`` as string. Pass a schema for anything large.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return (
        reader.schema(schema)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


# The column that holds a line which does not fit the schema; two digits so that no click log has it.
LINE = "_rejected_line_00"


def read_clicks_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A click log in CSV, and its lines that do not fit: ``line, reason``.

    ``reason`` is ``width`` for a line with more or fewer fields than the schema, ``type`` for one with a field that cannot
    be read as its type. Plain ``read_clicks_csv`` turns such fields into nulls, with which a click would lose its label
    and its counts. The log is parsed once, with all its columns, into a table that both are read from.
    """
    whole = StructType([*schema.fields, StructField(LINE, StringType())])
    rows = (
        spark.read.option("header", header)
        .schema(whole)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("enforceSchema", True)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )
    rows = stored(rows, "parsed-clicks")
    # Fields of the line, with what stands between quotes taken out of the way.
    fields = F.size(F.split(F.regexp_replace(LINE, r'"([^"\\]|\\.)*"', "q"), ",", -1))
    reason = F.when(fields != len(schema.fields), "width").otherwise("type")
    good = rows.filter(F.col(LINE).isNull()).drop(LINE)
    return good, rows.filter(F.col(LINE).isNotNull()).select(F.col(LINE).alias("line"), reason.alias("reason"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Label/feature tables and predictions."""
    return spark.read.parquet(path)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A click log derived from the ``events`` table, with ``event_id`` kept as the row's key."""
    k = F.get_json_object("props", "$.k").cast("int")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", k)
    installed = (F.col("k") % 10 < 3) & F.col("event_type").isin("click", "purchase")
    return events.select(
        "event_id",
        F.col("user_id").alias("ip"),
        (F.col("k") % 10).alias("app"),
        (F.col("k") % 3).alias("device"),
        F.expr("CAST(k DIV 10 AS INT)").alias("os"),
        F.col("event_type").alias("channel"),
        F.col("ts").alias("click_time"),
        F.lit(None).cast("timestamp").alias("attributed_time"),
        installed.cast("int").alias("is_attributed"),
    )
