"""A corpus through five stages: quality classifier, line dedup, near-dedup, benchmark decontamination, mixing.

Each stage takes the documents that its predecessor kept and returns documents with the same columns; the last returns
the mix, a row per time a document is read. Stages are written as Parquet and read again, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickcast.llm.common import written
from clickcast.llm.decontaminate import drop_contaminated
from clickcast.llm.linededup import drop_recurring_lines
from clickcast.llm.mixing import mixed_documents
from clickcast.llm.neardup import drop_near_duplicates
from clickcast.llm.quality import drop_low_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(docs, length_col="n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# Some stages have no form in SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None
