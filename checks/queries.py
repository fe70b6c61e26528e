"""One query per operator. Each takes ``(spark, sf_dir)``, runs over whole tables and returns a DataFrame."""

from __future__ import annotations

from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.functions import add_time_parts, hash_split, prepare_clicks, random_split, show_rows
from clickcast.operators.bayes import TableNaiveBayesModel
from clickcast.operators.boosting import SecondOrderBoosting
from clickcast.operators.counts import GROUPS, OPTIONAL_GROUPS, add_group_count, click_features, group_counts, with_all_keys
from clickcast.operators.encode import (
    CATEGORIES,
    encoder,
    feature_rows,
    fit_encoder,
    hash_collisions,
    index_labels,
    join_indices,
    label_counts,
    load_encoder,
    merge_encoders,
    moved_indices,
    numeric_columns,
    one_hot_long,
    read_features,
    save_encoder,
    vector_entries,
)
from clickcast.operators.evaluate import auroc_label, auroc_score
from clickcast.operators.models import BOOSTED, REGISTRY
from clickcast.operators.rates import fit_rates, fold_of
from clickcast.operators.tuning import fit, tune
from clickcast.plans import jobs
from clickcast.session import scratch_path, stored
from clickcast.sources import (
    clicks,
    read_clicks_checked,
    read_clicks_csv,
    read_parquet,
    write_clicks_csv,
    write_metric,
    write_parquet,
    write_predictions_csv,
)

ALL_GROUPS = {**GROUPS, **OPTIONAL_GROUPS}
# Where ``every second click comes from address 1`` the hot path must run at test scale.
SKEW_HOT_ROWS = 1000


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_clicks(clicks(spark, sf_dir))


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return hash_split(_prepared(spark, sf_dir), "event_id")


def _vectors(df: DataFrame) -> DataFrame:
    """``df`` through a file, which turns the fields of vectors into vector columns."""
    path = scratch_path(df.sparkSession, "vectors")
    write_parquet(df, path)
    return read_features(df.sparkSession, path)


def _encoded(spark: SparkSession, sf_dir: str, *wanted: int, features: str = "onehot") -> list[DataFrame]:
    """``event_id, label, features`` of the training (0) and held-out (1) part; the encoder is fitted on the former."""
    # Every count and lookup reads its part again, so each is made once.
    parts = {i: stored(part, "clicks") for i, part in enumerate(_parts(spark, sf_dir)) if i in {0, *wanted}}
    model = fit_encoder(with_all_keys(parts[0]))
    kept = ("event_id", "label")
    return [_vectors(feature_rows(click_features(parts[i]), model, *kept, source=parts[i], features=features)) for i in wanted]


def _long(indexed: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_Index").alias("label_index")) for c in CATEGORIES]
    return indexed.select("event_id", F.inline(F.array(*pairs)))


# Scans and sinks


def _printable(df: DataFrame) -> DataFrame:
    """``click_time`` as text with microseconds, without the all-null ``attributed_time``."""
    text = F.date_format("click_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumn("click_time", text).drop("attributed_time")


def csv_scan(spark, sf_dir):
    log, path = clicks(spark, sf_dir), scratch_path(spark, "csv")
    write_clicks_csv(log, path)
    return _printable(read_clicks_csv(spark, path, log.schema))


def csv_scan_inferred(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_clicks_csv(clicks(spark, sf_dir), path)
    return _printable(read_clicks_csv(spark, path)).withColumns(
        {c: F.col(c).cast("bigint") for c in ("event_id", "ip")}
    )


def parquet_scan(spark, sf_dir):
    path = scratch_path(spark, "labelfeatures")
    write_parquet(*_encoded(spark, sf_dir, 0), path)
    return vector_entries(read_parquet(spark, path), "features", "event_id", "label")


def partitioned_sink(spark, sf_dir):
    path = scratch_path(spark, "tests")
    write_parquet(*_encoded(spark, sf_dir, 1), path, files=50)
    return vector_entries(read_parquet(spark, path), "features", "event_id", "label")


def pipeline_roundtrip(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_encoder(fit_encoder(with_all_keys(train), kind="pipeline"), path)
    return _long(PipelineModel(load_encoder(spark, path).stages[:-1]).transform(test))


def unfitted_pipeline(spark, sf_dir):
    """The unfitted pipeline, saved, loaded and fitted: the same indices."""
    train, test = _parts(spark, sf_dir)
    path = scratch_path(spark, "pipeline")
    encoder(numeric=()).write().overwrite().save(path)
    return _long(Pipeline.load(path).fit(with_all_keys(train)).transform(test))


def pipeline_features(spark, sf_dir):
    """Held-out features from the encoder as a ``PipelineModel``."""
    train, test = _parts(spark, sf_dir)
    model = fit_encoder(with_all_keys(train), kind="pipeline")
    return vector_entries(feature_rows(click_features(test), model, "event_id", "label"), "features", "event_id", "label")


def predictions_csv(spark, sf_dir):
    path = scratch_path(spark, "prediction")
    write_predictions_csv(_scored(spark, sf_dir, "dt", {}), path)
    return spark.read.csv(path, header=True, schema="label int, score double, prediction double")


def metric_sink(spark, sf_dir):
    path = scratch_path(spark, "auroc")
    write_metric(spark, _count_auroc(spark, sf_dir), path)
    return spark.read.csv(path, schema="value string").select(F.round(F.col("value").cast("double"), 9).alias("auroc"))


def rejected_lines(spark, sf_dir):
    """A log with planted faults, by reason: a field too few, one too many, text for a number, a time that is none."""
    log, path = clicks(spark, sf_dir), scratch_path(spark, "faulty")
    options = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    line, kind = F.to_csv(F.struct("*"), options), F.col("event_id") % 50
    faulty = (
        F.when(kind == 0, F.regexp_replace(line, ",[^,]*$", ""))
        .when(kind == 1, F.concat(line, F.lit(",1")))
        .when(kind == 2, F.concat(F.lit("no"), line))
        .when(kind == 3, F.regexp_replace(line, "2024-", "some day in "))
        .otherwise(line)
    )
    log.select(faulty).write.text(path)
    good, bad = read_clicks_checked(spark, path, log.schema, header=False)
    ids = F.regexp_extract("line", "[0-9]+", 0).cast("bigint").alias("event_id")
    both = bad.select("reason", ids).unionByName(good.select(F.lit("none").alias("reason"), "event_id"))
    return both.groupBy("reason").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


# Projections and row movement


def time_parts(spark, sf_dir):
    return add_time_parts(clicks(spark, sf_dir), minute=True).select("event_id", "hour", "day", "minute")


def click_projection(spark, sf_dir):
    return _prepared(spark, sf_dir)


def preview(spark, sf_dir):
    """How many rows a preview shows, and how many of them are rows of the table."""
    log = _prepared(spark, sf_dir)
    shown = show_rows(log, 10)
    return shown.join(log, log.columns, "left_semi").agg(F.count("*").alias("known")).crossJoin(
        shown.agg(F.count("*").alias("shown"))
    )


def numeric_names(spark, sf_dir):
    """The numeric columns that are found in the table of counts, with their sums."""
    counted = click_features(_prepared(spark, sf_dir))
    found = numeric_columns(counted, other=("label", "event_id"))
    sums = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("name"), F.sum(c).alias("total")) for i, c in enumerate(found)]
    return counted.agg(F.array(*sums).alias("found")).select(F.inline("found"))


def split_train(spark, sf_dir):
    return _parts(spark, sf_dir)[0].select("event_id")


def split_test(spark, sf_dir):
    return _parts(spark, sf_dir)[1].select("event_id")


def random_split_whole(spark, sf_dir):
    """Both sides of the random split together: every click once."""
    train, test = random_split(clicks(spark, sf_dir))
    return train.select("event_id").unionAll(test.select("event_id"))


def random_split_share(spark, sf_dir):
    """Whether the larger side has nine tenths, to four standard deviations."""
    train, test = (part.agg(F.count("*").cast("double").alias(n)) for part, n in zip(random_split(clicks(spark, sf_dir)), "ab"))
    n = F.col("a") + F.col("b")
    return train.crossJoin(test).select((F.abs(F.col("a") - 0.9 * n) <= 4 * F.sqrt(0.09 * n)).alias("nine_to_one"))


# Counts


def group_count(name, spark, sf_dir):
    return group_counts(_prepared(spark, sf_dir), ALL_GROUPS[name], name)


def count_on_clicks(name, spark, sf_dir):
    return add_group_count(_prepared(spark, sf_dir), ALL_GROUPS[name], name).select("event_id", name)


def features_by(method, spark, sf_dir):
    return click_features(_prepared(spark, sf_dir), method=method)


def features_optional(spark, sf_dir):
    return click_features(_prepared(spark, sf_dir), ALL_GROUPS)


def features_null_keys(method, spark, sf_dir):
    ip = F.when(F.col("os") != 0, F.col("ip"))
    return click_features(_prepared(spark, sf_dir).withColumn("ip", ip), method=method)


def features_hot_ip(spark, sf_dir):
    ip = F.when(F.col("event_id") % 2 == 0, F.lit(1).cast("bigint")).otherwise(F.col("ip"))
    return click_features(_prepared(spark, sf_dir).withColumn("ip", ip), hot_rows=SKEW_HOT_ROWS)


def features_many_hot(spark, sf_dir):
    """Every address is frequent: none is shuffled whole."""
    return click_features(_prepared(spark, sf_dir), hot_rows=1)


def features_narrow_keys(spark, sf_dir):
    """Keys of a type that cannot hold a hash."""
    narrow = {c: F.col(c).cast("smallint") for c in ("app", "device", "os", "hour", "day")}
    widened = {c: F.col(c).cast("int") for c in narrow}
    return click_features(_prepared(spark, sf_dir).withColumns(narrow), method="join", hot_rows=SKEW_HOT_ROWS).withColumns(widened)


def features_counts_from_train(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    return click_features(test, counts_from=train)


# Encoding


def string_index(column, spark, sf_dir):
    return index_labels(_prepared(spark, sf_dir), [column]).select("label", "n", "label_index")


HASHED = {"ip": 64, "channel": 8}


def hashed_features(spark, sf_dir):
    """Held-out features with two columns hashed into a bounded number of signed positions, through a saved encoder."""
    train, test = _parts(spark, sf_dir)
    path = scratch_path(spark, "hashed")
    save_encoder(fit_encoder(with_all_keys(train), hashed=HASHED), path)
    rows = feature_rows(click_features(test), load_encoder(spark, path), "event_id", "label", source=test)
    return vector_entries(_vectors(rows), "features", "event_id", "label")


def hashed_collisions(spark, sf_dir):
    counts = label_counts(_prepared(spark, sf_dir), list(HASHED))
    return hash_collisions(stored(counts), HASHED)


def _halves(spark, sf_dir):
    return [fit_encoder(half, numeric=()) for half in hash_split(_prepared(spark, sf_dir), "event_id", 5, 3)]


def merged_labels(spark, sf_dir):
    """The labels of two encoders, each fitted on half of the clicks, merged: those of one fit."""
    return merge_encoders(*_halves(spark, sf_dir)).index.select("column", "label", "n", "label_index")


def moved_labels(spark, sf_dir):
    """Where the numbers of the first half's encoder are after the merge."""
    halves = _halves(spark, sf_dir)
    return moved_indices(halves[0], merge_encoders(*halves))


def string_index_unseen(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    model = fit_encoder(train.filter(F.col("app") != 9), ("app",), ())
    return model.transform(test).select("event_id", "app_Index")


def index_join(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    return _long(join_indices(test, index_labels(train)))


def one_hot(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    model = fit_encoder(train.filter(F.col("app") != 9))
    return one_hot_long(test, model, "event_id")


def features_long(part, spark, sf_dir):
    return vector_entries(*_encoded(spark, sf_dir, part), "features", "event_id", "label")


def label_table_features(spark, sf_dir):
    """Held-out features from an encoder that keeps its labels in a table, through a file."""
    train, test = _parts(spark, sf_dir)
    path = scratch_path(spark, "labels")
    save_encoder(fit_encoder(with_all_keys(train)), path)
    rows = feature_rows(click_features(test), load_encoder(spark, path), "event_id", "label", source=test)
    return vector_entries(_vectors(rows), "features", "event_id", "label")


# Classifiers


def _scored(spark, sf_dir, algorithm, params, features="onehot"):
    train, test = _encoded(spark, sf_dir, 0, 1, features=features)
    return fit(train.select("label", "features"), algorithm, params).transform(test)


def predict(algorithm, params, spark, sf_dir, features="onehot"):
    return _scored(spark, sf_dir, algorithm, params, features).select("event_id", "prediction")


def rf_area(spark, sf_dir):
    """Whether the forest with its own choice of features per node ranks the held-out clicks nearly without fault."""
    scored = _scored(spark, sf_dir, "rf", {"numTrees": 30})
    return spark.createDataFrame([(auroc_score(scored) >= 0.99,)], "ranks boolean")


def _stump(spark, sf_dir, algorithm, params):
    """A tree of one split over the one-hot blocks, as its saved model has it."""
    train, _ = _parts(spark, sf_dir)
    rows = _vectors(feature_rows(train, fit_encoder(train, numeric=()), source=train))
    path = scratch_path(spark, "stump")
    fit(rows, algorithm, params).save(path)
    return spark.read.parquet(f"{path}/data")


def dt_two_levels(spark, sf_dir):
    """The probability that a tree of two levels over the one-hot blocks gives each held-out click: its leaf's share."""
    train, test = _parts(spark, sf_dir)
    model = fit_encoder(train, numeric=())
    rows, asked = (_vectors(feature_rows(p, model, "event_id", "label", source=p)) for p in (train, test))
    scored = fit(rows.select("label", "features"), "dt", {"maxDepth": 2}).transform(asked)
    return scored.select("event_id", F.round(vector_to_array("probability")[1], 9).alias("score"))


def gbt_stump(spark, sf_dir):
    """One iteration of one split: the feature, and the mean of the labels as -1 and 1 on either side."""
    nodes = _stump(spark, sf_dir, "gbt", {"maxDepth": 1, "maxIter": 1}).select("nodeData.*")
    root, left, right = (nodes.filter(F.col("id") == i) for i in range(3))
    found = root.select(F.col("split.featureIndex").alias("position"))
    for node, side in ((left, "left"), (right, "right")):
        found = found.crossJoin(node.select(F.round("prediction", 9).alias(side)))
    return found


def boosted_stumps(spark, sf_dir):
    """Two rounds of one split each by second derivatives, over the one-hot blocks: the feature and what both sides add."""
    train, _ = _parts(spark, sf_dir)
    rows = _vectors(feature_rows(train, fit_encoder(train, numeric=()), source=train))
    settings = {"minChildWeight": BOOSTED["min_child_weight"], "baseScore": BOOSTED["base_score"], "stepSize": BOOSTED["eta"]}
    trees = SecondOrderBoosting(maxIter=2, maxDepth=1, **settings).fit(rows).trees
    found = [(i, t.position[0], round(t.value[1], 9), round(t.value[2], 9)) for i, t in enumerate(trees)]
    return spark.createDataFrame(found, "tree int, position int, absent double, present double")


# Rates


def _rates(spark, sf_dir):
    """The rates of the training part and both parts with their counts."""
    parts = _parts(spark, sf_dir)
    model = fit_rates(with_all_keys(parts[0]), fold_of("event_id"))
    return model, [click_features(p) for p in parts]


def rates_long(part, spark, sf_dir):
    """The rate of each category on each click: out of its fold on the training part (0), of all training clicks else (1)."""
    model, counted = _rates(spark, sf_dir)
    rows = model.add_rates(counted[part], None if part else fold_of("event_id"))
    pairs = [F.struct(F.lit(c).alias("column"), F.round(f"{c}_Rate", 9).alias("rate")) for c in CATEGORIES]
    return rows.select("event_id", F.inline(F.array(*pairs)))


def predict_rates(algorithm, params, spark, sf_dir):
    model, counted = _rates(spark, sf_dir)
    folds = (fold_of("event_id"), None)
    train, test = (
        _vectors(model.transform(rows, fold).select("event_id", "label", F.col("rate_features").alias("features")))
        for rows, fold in zip(counted, folds)
    )
    return fit(train.select("label", "features"), algorithm, params).transform(test).select("event_id", "prediction")


def dt_reloaded(spark, sf_dir):
    """Predictions of the saved and loaded tree on the saved features, as the tree job leaves them."""
    log, out = clicks(spark, sf_dir), scratch_path(spark, "tree")
    write_clicks_csv(log, f"{out}_log")
    jobs.preprocess(spark, f"{out}_log", out, log.schema, split="hash", key="event_id")
    names = (f"{out}_labelfeatures.parquet", f"{out}_pipeline_model", f"{out}_test", f"{out}_dt")
    jobs.train(spark, "dt", *names, log.schema, input_partitions=6, output_files=3)
    model = DecisionTreeClassificationModel.load(f"{out}_dt_trained_dt_model")
    rows = model.transform(read_features(spark, f"{out}_dt_vectorized_test_data"))
    return rows.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def nb_model(spark, sf_dir):
    """Every parameter of naive Bayes, from the saved and loaded table."""
    path = scratch_path(spark, "nb")
    fit(_encoded(spark, sf_dir, 0)[0].select("label", "features"), "nb", {"smoothing": 1.0}).save(path)
    model = TableNaiveBayesModel.load(spark, path)
    classes = F.array(*(F.struct(F.lit(float(c)).alias("label"), F.lit(round(p, 9)).alias("pi")) for c, p in enumerate(model.pi)))
    cells = model.all_theta().select("position", F.inline(F.arrays_zip(classes.alias("class"), F.col("theta"))))
    return cells.select("class.label", "position", "class.pi", F.round("theta", 9).alias("theta"))


def _nb_scored(spark, sf_dir):
    return _scored(spark, sf_dir, "nb", {"smoothing": 1.0})


def nb_predict(spark, sf_dir):
    return _nb_scored(spark, sf_dir).select("event_id", "prediction")


# Tuning and evaluation


def tune_nb(spark, sf_dir):
    estimator = REGISTRY["nb"].make(0)
    grid = REGISTRY["nb"].param_grid(estimator)
    found = tune(_encoded(spark, sf_dir, 0)[0], estimator, grid, split="hash", key="event_id")
    rows = [
        (params[estimator.smoothing], metric, int(params[estimator.smoothing] == found.best["smoothing"]))
        for params, metric in zip(grid, found.metrics, strict=True)
    ]
    made = spark.createDataFrame(rows, "smoothing double, auroc double, best int")
    return made.withColumn("auroc", F.round("auroc", 9))


def tune_lr(spark, sf_dir):
    """Held-out predictions of the model that wins the random train/validation search."""
    train, test = _encoded(spark, sf_dir, 0, 1)
    return fit(train.select("label", "features"), "lr").model.transform(test).select("event_id", "prediction")


def tune_trees(algorithm, spark, sf_dir):
    """The whole grid over label indices and counts, with the area of each point and the winner."""
    (train,) = _encoded(spark, sf_dir, 0, features="indices")
    # Boosting by second derivatives learns from a table of its own.
    found = fit(train, algorithm, persist=algorithm != "boosted", split="hash", key="event_id")
    best = found.metrics.index(max(found.metrics))
    rows = [
        (",".join(sorted(f"{p.name}={float(v)}" for p, v in point.items())), round(metric, 9), int(i == best))
        for i, (point, metric) in enumerate(zip(found.grid, found.metrics, strict=True))
    ]
    return spark.createDataFrame(rows, "point string, auroc double, best int")


def _one(spark, value):
    return spark.createDataFrame([(round(value, 9),)], "auroc double")


def auroc_label_nb(spark, sf_dir):
    return _one(spark, auroc_label(_nb_scored(spark, sf_dir)))


def _count_auroc(spark, sf_dir):
    counted = add_group_count(_prepared(spark, sf_dir), GROUPS["app_day_h_dev"], "app_day_h_dev")
    return auroc_score(counted.withColumn("score", F.col("app_day_h_dev").cast("double")), "score")


def auroc_score_count(spark, sf_dir):
    """How well one count alone ranks the clicks: integer scores, so nearly every score is tied."""
    return _one(spark, _count_auroc(spark, sf_dir))


# Jobs


def job_chain(spark, sf_dir, algorithm="nb", params=(("smoothing", 1.0),), features="onehot", **options):
    """Preprocess, train and evaluate through files: by default naive Bayes over the full feature vector."""
    log, out = clicks(spark, sf_dir), scratch_path(spark, "jobs")
    write_clicks_csv(log, f"{out}_log")
    jobs.preprocess(spark, f"{out}_log", out, log.schema, split="hash", key="event_id", rates=features == "rates", **options)
    jobs.train(
        spark,
        algorithm,
        f"{out}_labelfeatures.parquet",
        f"{out}_pipeline_model",
        f"{out}_test",
        f"{out}_{algorithm}",
        log.schema,
        dict(params),
        features=features,
        rates=f"{out}_rates",
    )
    jobs.evaluate(spark, f"{out}_{algorithm}_predicts.parquet", f"{out}_{algorithm}")
    read = spark.read.csv(f"{out}_{algorithm}_auroc", schema="value string")
    return read.select(F.round(F.col("value").cast("double"), 9).alias("auroc"))


QUERIES = {
    "csv_scan": csv_scan,
    "csv_scan_inferred": csv_scan_inferred,
    "rejected_lines": rejected_lines,
    "parquet_scan": parquet_scan,
    "partitioned_sink": partitioned_sink,
    "pipeline_roundtrip": pipeline_roundtrip,
    "unfitted_pipeline": unfitted_pipeline,
    "pipeline_features": pipeline_features,
    "predictions_csv": predictions_csv,
    "metric_sink": metric_sink,
    "time_parts": time_parts,
    "click_projection": click_projection,
    "preview": preview,
    "numeric_names": numeric_names,
    "split_train": split_train,
    "split_test": split_test,
    "random_split": random_split_whole,
    "random_split_share": random_split_share,
    **{f"group_{n.lower()}": partial(group_count, n) for n in ALL_GROUPS},
    **{f"count_{n.lower()}": partial(count_on_clicks, n) for n in ALL_GROUPS},
    "click_features": partial(features_by, "split"),
    "click_features_join": partial(features_by, "join"),
    "click_features_window": partial(features_by, "window"),
    "click_features_optional": features_optional,
    "click_features_null_keys": partial(features_null_keys, "split"),
    "click_features_null_keys_join": partial(features_null_keys, "join"),
    "click_features_null_keys_window": partial(features_null_keys, "window"),
    "click_features_hot_ip": features_hot_ip,
    "click_features_many_hot": features_many_hot,
    "click_features_narrow_keys": features_narrow_keys,
    "click_features_counts_from_train": features_counts_from_train,
    **{f"string_index_{c}": partial(string_index, c) for c in CATEGORIES},
    "hashed_features": hashed_features,
    "hashed_collisions": hashed_collisions,
    "merged_labels": merged_labels,
    "moved_labels": moved_labels,
    "string_index_unseen": string_index_unseen,
    "index_join": index_join,
    "one_hot_long": one_hot,
    "feature_rows": partial(features_long, 0),
    "held_out_features": partial(features_long, 1),
    "label_table_features": label_table_features,
    "dt_predict": partial(predict, "dt", {}),
    # With every feature at every node the forest finds all labels; with its own choice it misses some.
    "rf_predict": partial(predict, "rf", {"numTrees": 30, "featureSubsetStrategy": "all"}),
    "rf_area": rf_area,
    "gbt_predict": partial(predict, "gbt", {"maxIter": 10, "maxDepth": 5}),
    "lr_predict": partial(predict, "lr", {"regParam": 0.01, "elasticNetParam": 0.0}),
    "boosted_predict": partial(predict, "boosted", {"round": 20, "eta": 0.1}),
    # A label's place in the order of frequency takes more splits to reach than a feature of its own.
    "dt_predict_indices": partial(predict, "dt", {"maxDepth": 10}, features="indices"),
    "rf_predict_indices": partial(
        predict, "rf", {"numTrees": 30, "featureSubsetStrategy": "all", "maxDepth": 10}, features="indices"
    ),
    "gbt_predict_indices": partial(predict, "gbt", {"maxIter": 10, "maxDepth": 5}, features="indices"),
    "boosted_predict_indices": partial(predict, "boosted", {"round": 20, "eta": 0.1}, features="indices"),
    "boosted_gbt_predict_indices": partial(predict, "boosted_gbt", {"round": 20, "eta": 0.1}, features="indices"),
    "dt_two_levels": dt_two_levels,
    "gbt_stump": gbt_stump,
    "boosted_stumps": boosted_stumps,
    "train_rates": partial(rates_long, 0),
    "held_out_rates": partial(rates_long, 1),
    # Labels ordered by rate: three splits find what takes ten over labels ordered by frequency.
    "dt_predict_rates": partial(predict_rates, "dt", {"maxDepth": 3}),
    "boosted_predict_rates": partial(predict_rates, "boosted", {"round": 20, "eta": 0.1}),
    "dt_reloaded": dt_reloaded,
    "nb_model": nb_model,
    "nb_predict": nb_predict,
    "tune_nb": tune_nb,
    "tune_lr": tune_lr,
    "tune_rf": partial(tune_trees, "rf"),
    "tune_gbt": partial(tune_trees, "gbt"),
    "tune_boosted": partial(tune_trees, "boosted"),
    "auroc_label": auroc_label_nb,
    "auroc_score": auroc_score_count,
    "job_chain": job_chain,
    "job_chain_dt": partial(job_chain, algorithm="dt", params=()),
    "job_chain_gbt": partial(job_chain, algorithm="gbt", params=(("maxIter", 10), ("maxDepth", 5)), features="indices"),
    # Three levels over rates, from a log that is checked line by line.
    "job_chain_rates": partial(job_chain, algorithm="dt", params=(("maxDepth", 3),), features="rates", rejected=True),
    "job_chain_lr": partial(job_chain, algorithm="lr", params=(("regParam", 0.01), ("elasticNetParam", 0.0))),
}
