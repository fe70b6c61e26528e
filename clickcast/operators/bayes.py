"""Multinomial naive Bayes whose parameters are a table, however many features there are.

The fit is one aggregation: the sum of every feature by class. With N_c rows and a feature total of T_c in class c, F features
and smoothing s, ``pi_c = ln(N_c + s) - ln(N + C s)`` and ``theta_cf = ln(T_cf + s) - ln(T_c + F s)``; a class scores
``pi_c + sum of value * theta_cf`` over a row's non-zero entries. Features that occur in no row have no row in the table and
all the same theta.

Scores need each entry's theta. The first and the last ``LOOKED_UP`` positions are held in arrays that every task gets, and
a row's sum over them is taken where the row is; they and two numbers per class are all that the driver holds: for features numbered by falling
frequency, block by block, these are the frequent labels of the first block and all of the short blocks. If there are no
others, nothing is shuffled. The entries in between, at most one per row where only the first block is long, are joined by
position, with frequent positions spread (see ``joins``), and each row's parts are summed by row number.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import inf, log

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.operators.encode import vector_arrays, vector_entries
from clickcast.operators.joins import HOT_ROWS, frequent_keys, spread_join
from clickcast.session import checkpointed, empty_folder, scratch_path

# Positions at either end of the vector whose parameters go to the driver and to every task.
LOOKED_UP = 20_000


class _Columns(HasLabelCol, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    smoothing = Param(Params._dummy(), "smoothing", "what is added to every count", TypeConverters.toFloat)

    def getSmoothing(self) -> float:
        return self.getOrDefault(self.smoothing)


@dataclass(frozen=True)
class ClassSums:
    """``table``: ``position, sums`` by class; rows and feature totals per class; features in a vector."""

    table: DataFrame
    rows: list[int]
    totals: list[float]
    width: int


def class_sums(df: DataFrame, label: str = "label", features: str = "features") -> ClassSums:
    """The sum of every feature by class, written as a table. Labels are 0, 1, ..., values must not be negative."""
    spark = df.sparkSession
    sizes = df.groupBy(F.col(label).cast("int").alias("c")).agg(
        F.count("*").alias("n"), F.max(F.coalesce(vector_arrays(df, features)["size"], F.size(vector_arrays(df, features)["values"]))).alias("w")
    )
    found = {r["c"]: r for r in sizes.collect()}
    if not found:
        raise ValueError("no rows to learn from")
    classes = range(max(2, max(found) + 1))
    width = max(r["w"] for r in found.values())
    wrong = F.raise_error(F.concat(F.lit("negative feature value at position "), F.col("position"))).cast("double")
    value = F.when(F.col("value") < 0, wrong).otherwise(F.col("value"))
    sums = [F.coalesce(F.sum(F.when(F.col(label).cast("int") == c, value)), F.lit(0.0)) for c in classes]
    path = scratch_path(spark, "class-sums")
    vector_entries(df, features, label).groupBy("position").agg(F.array(*sums).alias("sums")).write.parquet(path)
    table = spark.read.parquet(path)
    totals = table.agg(*(F.coalesce(F.sum(F.col("sums")[c]), F.lit(0.0)) for c in classes)).first()
    return ClassSums(table, [found[c]["n"] if c in found else 0 for c in classes], list(totals), width)


def _log(x: float) -> float:
    return log(x) if x > 0 else -inf


def _adding(at_start: Column, low: int, at_end: Column | None, high: int):
    """Adds an entry's value times its theta, which is in the array of the first or of the last positions."""

    def add(score, entry):
        theta = F.get(at_start, entry["p"])
        if at_end is not None:
            theta = F.when(entry["p"] < low, theta).otherwise(F.get(at_end, entry["p"] - high))
        return score + entry["v"] * theta

    return add


class TableNaiveBayes(Estimator, _Columns):
    """Naive Bayes over a vector column; several smoothings share one aggregation (``fitMultiple``)."""

    @keyword_only
    def __init__(self, *, smoothing: float = 1.0, labelCol: str = "label", featuresCol: str = "features"):
        super().__init__()
        self._setDefault(smoothing=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TableNaiveBayesModel:
        return self._model(class_sums(dataset, self.getLabelCol(), self.getFeaturesCol()))

    def fitMultiple(self, dataset, paramMaps):
        sums = class_sums(dataset, self.getLabelCol(), self.getFeaturesCol())
        return iter([(i, self.copy(params)._model(sums)) for i, params in enumerate(paramMaps)])

    def _model(self, sums: ClassSums) -> TableNaiveBayesModel:
        s = self.getSmoothing()
        rest = [_log(t + sums.width * s) for t in sums.totals]
        count = lambda c: F.col("sums")[c] + s
        theta = [F.when(count(c) > 0, F.log(count(c)) - rest[c]).otherwise(-inf) for c in range(len(rest))]
        n = sum(sums.rows) + len(rest) * s
        model = TableNaiveBayesModel(
            sums.table.select("position", F.array(*theta).alias("theta")),
            [_log(r + s) - log(n) for r in sums.rows],
            [_log(s) - r if s else -inf for r in rest],
            sums.width,
        )
        return self._copyValues(model)


class TableNaiveBayesModel(Model, _Columns):
    """``theta``: ``position, theta`` by class for the features that occur; ``pi``; ``unseen``: theta of all others."""

    def __init__(self, theta: DataFrame, pi: list[float], unseen: list[float], width: int):
        super().__init__()
        self._setDefault(smoothing=1.0)
        self.theta, self.pi, self.unseen, self.width = theta, pi, unseen, width
        self.looked_up, self.hot_rows, self._rows = LOOKED_UP, HOT_ROWS, None

    @property
    def numFeatures(self) -> int:
        return self.width

    def all_theta(self, low: int = 0, high: int | None = None) -> DataFrame:
        """``position, theta`` for every position from ``low`` to before ``high``, in no order."""
        spark = self.theta.sparkSession
        places = spark.range(low, self.width if high is None else high).select(F.col("id").cast("int").alias("position"))
        unseen = F.array(*(F.lit(x) for x in self.unseen))
        return places.join(self.theta, "position", "left").select("position", F.coalesce("theta", unseen).alias("theta"))

    def _array(self, low: int, high: int, c: int) -> Column:
        """The thetas of class ``c`` from ``low`` to before ``high``, as one literal."""
        thetas = [self.unseen[c]] * (high - low)
        for r in self._looked_up():
            if low <= r["position"] < high:
                thetas[r["position"] - low] = r["theta"][c]
        return F.from_json(F.lit(json.dumps(thetas)), "array<double>")

    def _looked_up(self) -> list:
        at = F.col("position")
        if self._rows is None or self._rows[0] != self.looked_up:
            near = self.theta.filter((at < self.looked_up) | (at >= self.width - self.looked_up))
            self._rows = (self.looked_up, near.collect())
        return self._rows[1]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        low = min(self.looked_up, self.width)
        high = max(low, self.width - self.looked_up)
        classes = range(len(self.pi))
        scores = [f"_score_{c}" for c in classes]
        entries = F.col("_entries")
        v = vector_arrays(dataset, self.getFeaturesCol())
        places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
        zipped = F.filter(F.arrays_zip(places.alias("p"), v["values"].alias("v")), lambda e: e["v"] != 0)
        rows = dataset.withColumn("_entries", zipped)
        near = F.filter(entries, lambda e: (e["p"] < low) | (e["p"] >= high)) if low < high else entries
        for c in classes:
            at_start = self._array(0, low, c)
            at_end = self._array(high, self.width, c) if high < self.width else None
            rows = rows.withColumn(scores[c], F.aggregate(near, F.lit(float(self.pi[c])), _adding(at_start, low, at_end, high)))
        if low < high:
            rows = self._with_middle(rows, scores, low, high)
        return self._predicted(rows.drop("_entries"), scores).select(
            *dataset.columns, self.getRawPredictionCol(), self.getProbabilityCol(), self.getPredictionCol()
        )

    def _with_middle(self, rows: DataFrame, scores: list[str], low: int, high: int) -> DataFrame:
        """``scores`` with what entries from ``low`` to before ``high`` add: joined by position, summed by row."""
        between = F.filter("_entries", lambda e: (e["p"] >= low) & (e["p"] < high))
        kept = F.struct(*(F.col(f"`{c}`") for c in rows.columns if c != "_entries"))
        # Numbered first: in one step with the entries, each entry would get a number.
        long = rows.withColumn("_row", F.monotonically_increasing_id())
        long = long.select("_row", kept.alias("_kept"), F.posexplode_outer(between).alias("_n", "_e"))
        # The row itself goes with its first entry only.
        first = F.when(F.col("_n").isNull() | (F.col("_n") == 0), F.col("_kept"))
        long = long.select("_row", first.alias("_kept"), F.col("_e.p").alias("position"), F.col("_e.v").alias("_value"))
        table = self.theta.filter((F.col("position") >= low) & (F.col("position") < high))
        counted = long.filter("position is not null").groupBy("position").agg(F.count("*").alias("n"))
        frequent = checkpointed(frequent_keys(counted, "n", self.hot_rows).select("position").join(table, "position"))
        joined = spread_join(long, table, frequent, ["position"])
        adds = [
            F.sum(F.when(F.col("position").isNull(), 0.0).otherwise(F.col("_value") * F.coalesce(F.col("theta")[c], F.lit(self.unseen[c])))).alias(f"_add_{c}")
            for c in range(len(scores))
        ]
        summed = joined.groupBy("_row").agg(F.first("_kept", ignorenulls=True).alias("_kept"), *adds)
        plain = [c for c in rows.columns if c not in (*scores, "_entries")]
        return summed.select(
            *(F.col("_kept")[c].alias(c) for c in plain),
            *((F.col("_kept")[s] + F.col(f"_add_{c}")).alias(s) for c, s in enumerate(scores)),
        )

    def _predicted(self, rows: DataFrame, scores: list[str]) -> DataFrame:
        raw = F.array(*scores)
        most = F.greatest(*scores)
        # A row that no class can explain has all scores at minus infinity: the classes are then as likely as each other.
        weights = F.transform(raw, lambda s: F.when(most == -inf, 1.0).otherwise(F.exp(s - most)))
        total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
        return rows.withColumns(
            {
                self.getRawPredictionCol(): array_to_vector(raw),
                self.getProbabilityCol(): array_to_vector(F.transform(weights, lambda w: w / total)),
                # Of equal scores the first class wins.
                self.getPredictionCol(): (F.array_position(raw, most) - 1).cast("double"),
            }
        )

    def save(self, path: str) -> None:
        """``{path}/theta``, a row per feature, and ``{path}/classes``, a row per class. Replaces what is there."""
        spark = self.theta.sparkSession
        theta = checkpointed(self.theta)
        empty_folder(spark, path)
        theta.write.parquet(f"{path}/theta")
        rows = [(c, p, u, self.width, self.getSmoothing()) for c, (p, u) in enumerate(zip(self.pi, self.unseen))]
        kinds = "class int, pi double, unseen double, width int, smoothing double"
        spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{path}/classes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TableNaiveBayesModel:
        rows = spark.read.parquet(f"{path}/classes").orderBy("class").collect()
        theta = spark.read.parquet(f"{path}/theta")
        model = TableNaiveBayesModel(theta, [r["pi"] for r in rows], [r["unseen"] for r in rows], rows[0]["width"])
        return model._set(smoothing=rows[0]["smoothing"])
