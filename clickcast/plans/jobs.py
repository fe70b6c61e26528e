"""The three batch jobs. Files under an output prefix are the only interface between them.

``preprocess``  click log -> ``{out}_split.parquet``, ``{out}_test``, ``{out}_train.parquet``, ``{out}_pipeline``,
                ``{out}_pipeline_model``, ``{out}_frequent.parquet``, ``{out}_labelfeatures.parquet``, ``{out}_steps``
``train``       those -> ``{out}_clicks.parquet``, ``{out}_tests.parquet``, ``{out}_predicts.parquet``
``evaluate``    predictions -> ``{out}_auroc``
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from clickcast.functions import in_first_tenths, prepare_clicks
from clickcast.operators.counts import GROUPS, Groups, click_features, with_all_keys
from clickcast.operators.encode import (
    CATEGORIES,
    FEATURES,
    TableEncoder,
    encode,
    encoder,
    fit_encoder,
    frequent_labels,
    label_counts,
    load_encoder,
    read_features,
    save_encoder,
)
from clickcast.operators.evaluate import auroc_label, auroc_score
from clickcast.operators.joins import HOT_ROWS
from clickcast.operators.rates import FOLDS, RateEncoder, fit_rates, fold_of
from clickcast.operators.tuning import Tuned, fit
from clickcast.plans.steps import Steps
from clickcast.session import file_facts, path_exists
from clickcast.sources import (
    read_clicks_checked,
    read_clicks_csv,
    read_parquet,
    write_clicks_csv,
    write_metric,
    write_parquet,
    write_predictions_csv,
)


def preprocess(
    spark: SparkSession,
    input: str,
    out: str,
    schema=None,
    split: str = "random",
    key: str | None = None,
    seed: int = 0,
    groups: Groups = GROUPS,
    method: str = "split",
    hot_rows: int = HOT_ROWS,
    kind: str = "table",
    rates: bool = False,
    rejected: bool = False,
    hashed: Mapping[str, int] | None = None,
    signed: bool = True,
    resume: bool = False,
) -> PipelineModel | TableEncoder:
    """Split a click log nine to one, fit the encoder on the larger part and write its label/feature table.

    ``split="hash"`` splits on ``key``, a column of the log, ``split="random"`` by a draw per row. The log is parsed once,
    into ``{out}_split.parquet`` with a folder per side; every later pass reads only the columns it needs of that. ``kind``
    is the encoder's (see ``fit_encoder``); the table encoder also writes ``index_features``. ``rates`` adds
    ``rate_features``, each row's out of its own fold (see ``rates``), and ``{out}_rates``, for ``train(features="rates")``.
    ``rejected``, for which ``schema`` is needed, leaves out lines that do not fit it: they go to ``{out}_rejected``, with a
    folder per reason, and the clicks of a log without any are the same as without it. ``hashed`` and ``signed`` bound the
    width of columns (see ``TableEncoder``); naive Bayes and ``boosted`` take no negative values.

    Every step leaves a manifest in ``{out}_steps``. With ``resume`` a call that is asked for the same, over a log with the
    same files, goes on behind the last step that an earlier call has finished.
    """
    if split not in ("hash", "random"):
        raise ValueError(f"unknown split {split!r}")
    if rejected and schema is None:
        raise ValueError("lines can only be rejected by a schema")
    asked = {
        "files": file_facts(spark, input), "input": input, "schema": schema and schema.json(), "split": (split, key, seed),
        "groups": dict(groups), "method": method, "kind": kind, "options": (rates, rejected, hashed, signed),
    }
    steps = Steps(spark, f"{out}_steps", asked, resume)

    def split_log() -> dict:
        if rejected:
            raw, bad = read_clicks_checked(spark, input, schema)
            bad.write.mode("overwrite").partitionBy("reason").text(f"{out}_rejected")
        else:
            raw = read_clicks_csv(spark, input, schema)
        learn = in_first_tenths(key, 9) if split == "hash" else F.rand(seed) < 0.9
        sided = raw.withColumn("_side", F.when(learn, "train").otherwise("test"))
        if rates:
            # Fixed here, where the log is read once: by the key if there is one, else by a draw per row.
            fold = fold_of(key) if split == "hash" else F.floor(FOLDS * F.rand(seed + 1)).cast("int")
            sided = sided.withColumn("_fold", fold)
        sided.write.mode("overwrite").partitionBy("_side").parquet(f"{out}_split.parquet")
        return {"schema": sided.drop("_side").schema.json(), "columns": raw.columns, "sides": written_sides(spark, out)}

    parsed = steps.run("split", split_log)
    kinds = StructType.fromJson(json.loads(parsed["schema"]))

    def side(name: str) -> DataFrame:
        if name not in parsed["sides"]:
            return spark.createDataFrame([], kinds)
        return spark.read.schema(kinds).parquet(f"{out}_split.parquet/_side={name}")

    def write_parts() -> dict:
        write_clicks_csv(side("test").select(*parsed["columns"]), f"{out}_test")
        fold = ["_fold"] if rates else []
        write_parquet(prepare_clicks(side("train")).select(*CATEGORIES, "label", *fold), f"{out}_train.parquet")
        return {"train_rows": read_parquet(spark, f"{out}_train.parquet").count()}

    steps.run("parts", write_parts)
    rows = read_parquet(spark, f"{out}_train.parquet")
    # The encoder is fitted on the rows the counts keep, which needs no counting. The same label counts name the
    # addresses and labels that are too frequent for one task.
    kept = with_all_keys(rows, groups)

    def fit_encoders() -> dict:
        counts = label_counts(kept, CATEGORIES).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = fit_encoder(kept, numeric=tuple(groups), counts=counts, kind=kind, hashed=hashed, signed=signed)
            write_parquet(frequent_labels(counts, hot_rows), f"{out}_frequent.parquet")
            save_encoder(model, f"{out}_pipeline_model")
        finally:
            counts.unpersist()
        encoder(numeric=tuple(groups)).write().overwrite().save(f"{out}_pipeline")
        if rates:
            fit_rates(kept, F.col("_fold"), numeric=tuple(groups)).save(f"{out}_rates")
        return {"hot_rows": hot_rows}

    steps.run("encoder", fit_encoders)
    model = load_encoder(spark, f"{out}_pipeline_model")

    def write_features() -> dict:
        frequent = read_parquet(spark, f"{out}_frequent.parquet")
        hot = frequent.filter(F.col("column") == "ip").select(F.col("label").alias("ip"))
        counted = click_features(rows, groups, method, hot=hot, hot_rows=hot_rows)
        encoded = model.transform(counted, frequent) if isinstance(model, TableEncoder) else model.transform(counted)
        if rates:
            encoded = RateEncoder.load(spark, f"{out}_rates", numeric=tuple(groups)).transform(encoded, F.col("_fold"), hot_rows)
        vectors = [c for c in FEATURES.values() if c in encoded.columns]
        write_parquet(encoded.select("label", *vectors), f"{out}_labelfeatures.parquet")
        return {"rows": read_parquet(spark, f"{out}_labelfeatures.parquet").count()}

    steps.run("features", write_features)
    return model


def written_sides(spark: SparkSession, out: str) -> list[str]:
    """The sides of the split that have rows."""
    return [side for side in ("train", "test") if path_exists(spark, f"{out}_split.parquet/_side={side}")]


def train(
    spark: SparkSession,
    algorithm: str,
    labelfeatures: str,
    pipeline_model: str,
    test: str,
    out: str,
    schema=None,
    params: dict | None = None,
    seed: int | None = None,
    groups: Groups = GROUPS,
    counts_from: str | None = None,
    features: str = "onehot",
    method: str = "split",
    hot_rows: int = HOT_ROWS,
    input_partitions: int | None = None,
    output_files: int | None = None,
    rates: str | None = None,
    **tuning,
) -> Model | Tuned:
    """Fit one classifier, tuned over its grid unless ``params`` are given, and score the raw test split with it.

    The test split's counts are taken over the test split itself; ``counts_from``, the ``{out}_train.parquet`` of
    ``preprocess``, takes them over the training clicks instead. ``features="indices"`` learns from label indices and
    counts, as many numbers as there are columns, instead of a feature per label: for trees, which hold every row with one
    number per feature. ``features="rates"`` learns from the labels' rates instead of their indices; ``rates`` is the
    ``{out}_rates`` of ``preprocess``. ``method`` and ``hot_rows`` are those of ``click_features``. ``input_partitions`` and
    ``output_files`` override Spark's own choice. The decision tree also writes ``{out}_vectorized_test_data``, ``{out}_prediction`` and
    ``{out}_trained_dt_model``, and fails if one of them exists.
    """
    vector = FEATURES[features]
    if features == "rates" and rates is None:
        raise ValueError("name the rates that preprocess has written")
    rows = read_features(spark, labelfeatures).select("label", F.col(vector).alias("features"))
    if input_partitions is not None:
        rows = rows.repartition(input_partitions)
    model = load_encoder(spark, pipeline_model)
    # The CSV is parsed once; counting needs several passes.
    prepared = prepare_clicks(read_clicks_csv(spark, test, schema)).select(*CATEGORIES, "label")
    write_parquet(prepared, f"{out}_clicks.parquet")
    clicks = read_parquet(spark, f"{out}_clicks.parquet")
    source = read_parquet(spark, counts_from) if counts_from is not None else None
    counted = click_features(clicks, groups, method, counts_from=source, hot_rows=hot_rows)

    # The test features are written first and scored from the file: their counts are computed once.
    encoded = encode(counted, model, clicks, hot_rows)
    if features == "rates":
        encoded = RateEncoder.load(spark, rates, numeric=tuple(groups)).transform(encoded, hot_rows=hot_rows)
    if algorithm == "dt":
        write_parquet(encoded, f"{out}_vectorized_test_data", mode="errorifexists")
        encoded = read_parquet(spark, f"{out}_vectorized_test_data")
    write_parquet(encoded.select("label", F.col(vector).alias("features")), f"{out}_tests.parquet", files=output_files)
    tests = read_features(spark, f"{out}_tests.parquet")

    fitted = fit(rows, algorithm, params, seed, persist=input_partitions is not None, **tuning)
    best = fitted.model if isinstance(fitted, Tuned) else fitted
    write_parquet(best.transform(tests), f"{out}_predicts.parquet", files=output_files)
    if algorithm == "dt":
        write_predictions_csv(read_parquet(spark, f"{out}_predicts.parquet"), f"{out}_prediction")
        best.save(f"{out}_trained_dt_model")
    return fitted


def evaluate(spark: SparkSession, predictions: str, out: str) -> dict[str, float]:
    """Write the area under the ROC curve over the predicted classes to ``{out}_auroc``.

    The area over the scores, which shows ranking quality, goes to ``{out}_auroc_score``.
    """
    rows = read_parquet(spark, predictions)
    result = {"auroc_label": auroc_label(rows), "auroc_score": auroc_score(rows)}
    write_metric(spark, result["auroc_label"], f"{out}_auroc")
    write_metric(spark, result["auroc_score"], f"{out}_auroc_score")
    return result
