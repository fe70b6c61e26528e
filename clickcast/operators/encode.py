"""Categories to indices, indices to sparse one-hot blocks, blocks and counts to one feature vector.

A category's labels are numbered by falling frequency, ties by the label's text. Null and labels not seen in the fit get
the number after the last label, and a one-hot block of zeros.

The fitted encoder is a ``TableEncoder``: the labels stay in a table and are joined, however many there are. On request it
is a ``PipelineModel``, which holds every label in the memory of the driver and of each executor. Both give the same
vectors. The table encoder also gives ``index_features``: the indices themselves and the counts, for models that split on
ordered numbers and need not know every label as a feature of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructField, StructType

from clickcast.operators.counts import GROUPS
from clickcast.operators.joins import HOT_ROWS, frequent_keys, spread_join
from clickcast.session import checkpointed, current_version, empty_folder, path_exists, point_to, stored

# The categories in the order of their one-hot blocks. ``hour`` and ``day`` are also group keys.
CATEGORIES = ("ip", "app", "device", "os", "channel", "hour", "day")

# The labels of a column are broadcast up to this many; more are shuffled. The result is the same.
WIDE_LABELS = 10_000


def numeric_columns(df: DataFrame, categories: Sequence[str] = CATEGORIES, other: Sequence[str] = ("label",)) -> list[str]:
    """Columns that are neither a category nor the label, in the order of the table."""
    skipped = {*categories, *other}
    return [c for c in df.columns if c not in skipped]


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, label, n`` for every non-null value of every column, in one pass and one aggregation."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, label string, n bigint")
    # Whole numbers are counted as such and become text afterwards, once per label instead of once per row.
    whole = {c: isinstance(df.schema[c].dataType, (ByteType, ShortType, IntegerType, LongType)) for c in columns}
    number = lambda c: F.col(c).cast("bigint") if whole[c] else F.lit(None).cast("bigint")
    text = lambda c: F.lit(None).cast("string") if whole[c] else F.col(c).cast("string")
    cells = [F.struct(F.lit(i).alias("_at"), number(c).alias("_number"), text(c).alias("_text")) for i, c in enumerate(columns)]
    long = df.select(F.inline(F.array(*cells))).filter(F.col("_number").isNotNull() | F.col("_text").isNotNull())
    counted = long.groupBy("_at", "_number", "_text").agg(F.count("*").alias("n"))
    column = F.element_at(F.array(*map(F.lit, columns)), F.col("_at") + 1)
    return counted.select(column.alias("column"), F.coalesce(F.col("_number").cast("string"), "_text").alias("label"), "n")


def rank_labels(counts: DataFrame) -> DataFrame:
    """``column, label, n, label_index`` from ``label_counts``, which must be at hand.

    The labels of a column with at most WIDE_LABELS are ranked by a window, those of a longer one by a range-partitioned sort.
    """
    sizes = _sizes(counts)
    long = [c for c, size in sizes.items() if size > WIDE_LABELS]
    order = Window.partitionBy("column").orderBy(F.desc("n"), "label")
    place = (F.row_number().over(order) - 1).cast("double")
    ranked = counts.filter(~F.col("column").isin(*long)).withColumn("label_index", place)
    if long:
        ranked = ranked.unionByName(_rank_by_range(counts.filter(F.col("column").isin(*long))))
    return ranked.select("column", "label", "n", "label_index")


def _rank_by_range(counts: DataFrame) -> DataFrame:
    """No task sees more than its share of the labels. What is brought together is one row per partition and per column."""
    order = ["column", F.desc("n"), "label"]
    ordered = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id is the partition in the upper 31 bits and the row within it in the lower 33. It is read twice below, so it
    # is fixed by writing it.
    ordered = stored(ordered.withColumn("_id", F.monotonically_increasing_id()), "ranked-labels")
    ordered = ordered.select(
        "*", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_row")
    ).drop("_id")
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    placed = ordered.join(F.broadcast(starts), "_part").withColumn("_place", F.col("_start") + F.col("_row"))
    firsts = placed.groupBy("column").agg(F.min("_place").alias("_first"))
    return placed.join(F.broadcast(firsts), "column").select(
        "column", "label", "n", (F.col("_place") - F.col("_first")).cast("double").alias("label_index")
    )


def index_labels(df: DataFrame, columns: Sequence[str] = CATEGORIES) -> DataFrame:
    """``column, label, n, label_index`` for the values of ``columns``, written: every lookup reads it."""
    return stored(rank_labels(stored(label_counts(df, columns), "label-counts")), "labels")


def frequent_labels(counts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``column, label`` of the labels with at least ``hot_rows`` rows, from ``label_counts``, as a table at hand."""
    return checkpointed(frequent_keys(counts, "n", hot_rows).select("column", "label"))


def _sizes(index: DataFrame) -> dict[str, int]:
    """Labels per column: one number each."""
    return {r["column"]: r["n"] for r in index.groupBy("column").agg(F.count("*").alias("n")).collect()}


def join_indices(
    df: DataFrame,
    index: DataFrame,
    columns: Sequence[str] = CATEGORIES,
    frequent: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``<column>_Index`` for each column, looked up in a table from ``index_labels`` instead of a fitted model.

    A column with few labels is looked up by a broadcast, one with more than WIDE_LABELS by a spread join, which keeps
    nulls and frequent labels apart. ``frequent`` (``column, label``) are the labels of ``df`` whose rows should not meet in
    one task there; without it they are looked for.
    """
    sizes = _sizes(index)
    wide = [c for c in columns if sizes.get(c, 0) > WIDE_LABELS]
    if frequent is None and wide:
        frequent = frequent_labels(label_counts(df, wide), hot_rows)
    for c in columns:
        labels = index.filter(F.col("column") == c).select(
            F.col("label").alias("_label"), F.col("label_index").alias(f"{c}_Index")
        )
        rows = df.withColumn("_label", F.col(c).cast("string"))
        if c in wide:
            named = frequent.filter(F.col("column") == c).select(F.col("label").alias("_label"))
            joined = spread_join(rows, labels, named.join(labels, "_label", "left"), ["_label"])
        else:
            joined = rows.join(F.broadcast(labels), "_label", "left")
        unseen = F.lit(float(sizes.get(c, 0)))
        df = joined.withColumn(f"{c}_Index", F.coalesce(f"{c}_Index", unseen)).drop("_label")
    return df


def _sparse_fields(size, places: Column, values: Column) -> Column:
    """The fields of a sparse vector."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
        places.alias("indices"), values.alias("values"),
    )


def _sparse(size, entries: Column) -> Column:
    """The fields of a sparse vector from an array of ``position, value``."""
    return _sparse_fields(size, entries["position"], entries["value"])


def dense_fields(values: Sequence[Column]) -> Column:
    """The fields of a dense vector."""
    return F.struct(
        F.lit(1).cast("tinyint").alias("type"), F.lit(None).cast("int").alias("size"),
        F.lit(None).cast("array<int>").alias("indices"), F.array(*values).alias("values"),
    )


def _entry(position, value: Column) -> Column:
    position = position if isinstance(position, Column) else F.lit(position)
    return F.struct(position.cast("int").alias("position"), value.cast("double").alias("value"))


def number_column(name: str) -> Column:
    """A numeric column as a double; null is an error, as in the assembler of ``pyspark.ml``."""
    problem = F.raise_error(F.lit(f"null in the numeric column {name}")).cast("double")
    return F.when(F.col(name).isNull(), problem).otherwise(F.col(name).cast("double"))


def _digest(column: str) -> Column:
    return F.md5(F.concat(F.lit(f"{column}="), F.col(column).cast("string")).cast("binary"))


def hash_place(column: str, width: int) -> Column:
    """A label's position among ``width``, from the md5 of column and label; null for null."""
    return (F.conv(F.substring(_digest(column), 1, 8), 16, 10).cast("bigint") % width).cast("int")


def hash_sign(column: str) -> Column:
    """1 or -1, from other digits of the same md5, so that labels that share a position cancel out on average."""
    return F.when(F.conv(F.substring(_digest(column), 9, 1), 16, 10).cast("int") % 2 == 0, 1.0).otherwise(-1.0)


def hash_collisions(counts: DataFrame, hashed: Mapping[str, int]) -> DataFrame:
    """``column, labels, shared, rows_shared`` from ``label_counts``: labels that share a position, and their rows."""
    parts = []
    for c, width in hashed.items():
        own = counts.filter(F.col("column") == c).select("column", F.col("label").alias(c), "n")
        parts.append(own.groupBy("column", hash_place(c, width).alias("place")).agg(F.count("*").alias("labels"), F.sum("n").alias("n")))
    shared = F.col("labels") > 1
    return reduce(DataFrame.unionByName, parts).groupBy("column").agg(
        F.sum("labels").alias("labels"),
        F.sum(F.when(shared, F.col("labels")).otherwise(0)).alias("shared"),
        F.sum(F.when(shared, F.col("n")).otherwise(0)).alias("rows_shared"),
    )


@dataclass(frozen=True)
class TableEncoder:
    """A fitted encoder whose labels are the table ``index``, from ``rank_labels``.

    Columns in ``hashed`` have no labels there: their blocks have the width given, and a label's position is a hash, with the
    value 1, or 1 or -1 if ``signed``. Their labels are never counted or looked up, and unseen ones have a position too.

    ``transform`` adds ``<column>_Index`` and ``<column>_Vec`` for each category, ``features`` and ``index_features``. The
    vectors have the fields of a vector column, but become one only when they are written to parquet and read with
    ``read_features``.
    """

    index: DataFrame
    categories: Sequence[str] = CATEGORIES
    numeric: Sequence[str] = tuple(GROUPS)
    hashed: Mapping[str, int] = field(default_factory=dict)
    signed: bool = True

    @cached_property
    def sizes(self) -> dict[str, int]:
        found = {**_sizes(self.index), **self.hashed}
        return {c: found.get(c, 0) for c in self.categories}

    @property
    def wide(self) -> list[str]:
        """The columns whose labels are too many for a broadcast."""
        return [c for c, size in self.sizes.items() if size > WIDE_LABELS and c not in self.hashed]

    def transform(self, df: DataFrame, frequent: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
        indexed = join_indices(df, self.index, [c for c in self.categories if c not in self.hashed], frequent, hot_rows)
        for c, width in self.hashed.items():
            indexed = indexed.withColumn(f"{c}_Index", F.coalesce(hash_place(c, width), F.lit(width)).cast("double"))
        none = F.array().cast("array<struct<position:int,value:double>>")
        blocks, places, values, start = {}, [], [], 0
        for c, size in self.sizes.items():
            at, one = F.col(f"{c}_Index"), hash_sign(c) if self.signed and c in self.hashed else F.lit(1.0)
            blocks[f"{c}_Vec"] = _sparse(size, F.when(at < size, F.array(_entry(at, one))).otherwise(none))
            places.append(F.when(at < size, (start + at).cast("int")).otherwise(-1))
            values.append(F.when(at < size, one).otherwise(0.0))
            start += size
        for i, c in enumerate(self.numeric):
            value = number_column(c)
            places.append(F.when(value != 0, start + i).otherwise(-1))
            values.append(value)
        # What is not there has the position -1 and the value zero, and both go; a function by entry would take many times as long.
        vector = _sparse_fields(start + len(self.numeric), F.array_remove(F.array(*places), -1), F.array_remove(F.array(*values), 0.0))
        ordered = dense_fields([*(F.col(f"{c}_Index") for c in self.categories), *(number_column(c) for c in self.numeric)])
        return indexed.withColumns({**blocks, "features": vector, "index_features": ordered})

    def save(self, path: str) -> None:
        """The table of labels and the layout, in an empty folder."""
        names = enumerate([*self.categories, *self.numeric])
        layout = [(i, c, c in self.categories, self.hashed.get(c), self.signed) for i, c in names]
        kinds = "place int, column string, category boolean, width int, signed boolean"
        columns = self.index.sparkSession.createDataFrame(layout, kinds)
        self.index.write.partitionBy("column").parquet(f"{path}/labels")
        columns.coalesce(1).write.parquet(f"{path}/layout")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TableEncoder:
        layout = spark.read.parquet(f"{path}/layout").orderBy("place").collect()
        categories, numeric = ([r["column"] for r in layout if r["category"] is kind] for kind in (True, False))
        hashed = {r["column"]: r["width"] for r in layout if "width" in r and r["width"] is not None}
        signed = all(r["signed"] for r in layout if "signed" in r)
        # With every category hashed there are no labels, and no file of them.
        labels = spark.read.schema("label string, n bigint, label_index double, column string").parquet(f"{path}/labels")
        return TableEncoder(labels, tuple(categories), tuple(numeric), hashed, signed)


def merge_encoders(first: TableEncoder, *others: TableEncoder) -> TableEncoder:
    """One encoder as if fitted on the rows of all of them: a day's counts are added to those of the days before.

    Only the tables of labels are read. Labels keep no number; see ``moved_indices``.
    """
    columns = lambda e: (tuple(e.categories), tuple(e.numeric), dict(e.hashed), e.signed)
    if any(columns(o) != columns(first) for o in others):
        raise ValueError("encoders of different columns")
    counts = reduce(DataFrame.unionByName, (e.index.select("column", "label", "n") for e in (first, *others)))
    summed = stored(counts.groupBy("column", "label").agg(F.sum("n").alias("n")), "label-counts")
    return replace(first, index=stored(rank_labels(summed), "labels"))


def moved_indices(old: TableEncoder, new: TableEncoder) -> DataFrame:
    """``column, old_index, new_index`` of every label of ``old``, null where ``new`` lacks it.

    The number after the last label, which null and unseen labels have, has its new one too: the row without a label.
    """
    spark = old.index.sparkSession
    before = old.index.select("column", "label", F.col("label_index").alias("old_index"))
    after = new.index.select("column", "label", F.col("label_index").alias("new_index"))
    rest = [(c, float(old.sizes[c]), float(new.sizes[c])) for c in old.categories]
    unseen = spark.createDataFrame(rest, "column string, old_index double, new_index double")
    return before.join(after, ["column", "label"], "left").drop("label").unionByName(unseen)


def encode(
    df: DataFrame, model: PipelineModel | TableEncoder, source: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``model.transform(df)``. ``source`` has the categories of ``df`` and is cheaper to look for frequent labels in."""
    if not isinstance(model, TableEncoder):
        return model.transform(df)
    frequent = frequent_labels(label_counts(source, model.wide), hot_rows) if model.wide and source is not None else None
    return model.transform(df, frequent, hot_rows)


def save_encoder(model: PipelineModel | TableEncoder, path: str) -> PipelineModel | TableEncoder:
    """Save a fitted encoder of either kind, replacing what is there, and return it: a table as the one now on file.

    It is written whole into a folder of its own below ``path`` before the pointer to the current one is swapped, which is
    one rename: a failure leaves the encoder that was there, and readers see the old one or the new one. Then what the
    pointer named before is removed.
    """
    spark = model.index.sparkSession if isinstance(model, TableEncoder) else SparkSession.active()
    version = f"version-{uuid.uuid4().hex}"
    if isinstance(model, TableEncoder):
        model.save(f"{path}/{version}")
    else:
        model.write().save(f"{path}/{version}")
    old = current_version(spark, path)
    point_to(spark, path, version)
    saved = load_encoder(spark, path) if isinstance(model, TableEncoder) else model
    if old is not None:
        empty_folder(spark, f"{path}/{old}")
    return saved


def load_encoder(spark: SparkSession, path: str) -> PipelineModel | TableEncoder:
    """Load the current encoder of either kind: a table has a layout beside it. A plain ``PipelineModel`` folder will do."""
    version = current_version(spark, path)
    folder = path if version is None else f"{path}/{version}"
    return TableEncoder.load(spark, folder) if path_exists(spark, f"{folder}/layout") else PipelineModel.load(folder)


_VECTOR_FIELDS = ["type", "size", "indices", "values"]


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table with vectors, read as vector columns whichever encoder they come from."""
    df = spark.read.parquet(path)
    plain = [f for f in df.schema.fields if getattr(f.dataType, "names", None) == _VECTOR_FIELDS]
    if not plain:
        return df
    fields = [StructField(f.name, VectorUDT()) if f in plain else f for f in df.schema.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def encoder(categories: Sequence[str] = CATEGORIES, numeric: Sequence[str] = tuple(GROUPS)) -> Pipeline:
    """The unfitted encoder: one indexer and one one-hot encoder for all categories, and the assembler."""
    return Pipeline(stages=[_indexer(categories), *_after_index(categories, numeric)])


def _indexer(categories: Sequence[str]) -> StringIndexer:
    indexed = [f"{c}_Index" for c in categories]
    return StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep")


def _after_index(categories: Sequence[str], numeric: Sequence[str]) -> list:
    indexed, blocks = [f"{c}_Index" for c in categories], [f"{c}_Vec" for c in categories]
    return [
        OneHotEncoder(inputCols=indexed, outputCols=blocks),
        VectorAssembler(inputCols=[*blocks, *numeric], outputCol="features"),
    ]


def fit_encoder(
    df: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    numeric: Sequence[str] = tuple(GROUPS),
    counts: DataFrame | None = None,
    kind: str = "table",
    hashed: Mapping[str, int] | None = None,
    signed: bool = True,
) -> PipelineModel | TableEncoder:
    """Fit the encoder on the categories of ``df``; the numeric columns need not be there yet.

    ``hashed`` bounds the width of columns: see ``TableEncoder``.

    Labels are counted by a distributed aggregation (``counts``, if that is at hand) and ranked where they are. With
    ``kind="pipeline"`` all of them are brought to the driver and make a ``PipelineModel``: the caller's choice.
    """
    hashed = dict(hashed or {})
    if hashed and kind != "table":
        raise ValueError("only the table encoder has hashed columns")
    listed = [c for c in categories if c not in hashed]
    if counts is None:
        counts = stored(label_counts(df, listed), "label-counts")
    if kind == "table":
        # Written, since the sizes and every column's lookup read it.
        labels = stored(rank_labels(counts.filter(F.col("column").isin(*listed))), "labels")
        return TableEncoder(labels, tuple(categories), tuple(numeric), hashed, signed)
    if kind != "pipeline":
        raise ValueError(f"unknown kind {kind!r}")
    ranked = sorted(counts.collect(), key=lambda r: (-r["n"], r["label"]))
    indexers = [
        StringIndexerModel.from_labels(
            [r["label"] for r in ranked if r["column"] == c], inputCol=c, outputCol=f"{c}_Index", handleInvalid="keep"
        )
        for c in categories
    ]
    # The one-hot sizes come from the indexers' column metadata, so this fit reads no rows.
    return Pipeline(stages=[*indexers, *_after_index(categories, numeric)]).fit(df)


# The feature column by the name a caller asks for.
FEATURES = {"onehot": "features", "indices": "index_features", "rates": "rate_features"}


def feature_rows(
    df: DataFrame, model: PipelineModel | TableEncoder, *kept: str, source: DataFrame | None = None, features: str = "onehot"
) -> DataFrame:
    """``kept`` columns, by default ``label``, and the feature vector as ``features``. ``source`` as in ``encode``."""
    if features not in ("onehot", "indices"):
        raise ValueError(f"unknown features {features!r}")
    return encode(df, model, source).select(*(kept or ("label",)), F.col(FEATURES[features]).alias("features"))


def vector_arrays(df: DataFrame, vector: str) -> Column:
    """The fields ``type, size, indices, values`` of a vector column, of either form."""
    return F.unwrap_udt(vector) if isinstance(df.schema[vector].dataType, VectorUDT) else F.col(vector)


def vector_entries(df: DataFrame, vector: str, *kept: str) -> DataFrame:
    """``kept`` columns, ``position`` and ``value`` for every non-zero entry of a vector column.

    Reads the vector's own arrays: a sparse vector is never widened.
    """
    v = vector_arrays(df, vector)
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    entries = F.arrays_zip(places.alias("position"), v["values"].alias("value"))
    return df.select(*kept, F.inline(F.when(F.size(v["values"]) > 0, entries))).filter(F.col("value") != 0)


def one_hot_long(
    df: DataFrame, model: PipelineModel | TableEncoder, *kept: str, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """``kept`` columns, ``column``, ``position`` and ``value`` of the one-hot blocks; none for an unseen label."""
    model = replace(model, numeric=()) if isinstance(model, TableEncoder) else PipelineModel(model.stages[:-1])
    encoded = model.transform(df)
    blocks = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_Vec").alias("block")) for c in categories]
    long = encoded.select(*kept, F.inline(F.array(*blocks)))
    return vector_entries(long, "block", *kept, "column")
