"""Gradient boosting by first and second derivatives of the logistic loss, over histograms that Spark sums.

Every round adds a tree to the margin F, which starts at ``ln(b / (1 - b))`` for the base score b. A row with probability
p = 1 / (1 + exp(-F)) has derivatives g = p - y and h = p (1 - p). A node with sums G and H would add -G / (H + l2); a split
of it gains ``GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)``, counts only if HL and HR reach the least child weight,
and the best is taken, of equal gains the one at the lowest position and cut.

Values are cut into bins once: a feature with one value besides zero has that value as its only cut, others the distinct
quantiles. The histogram of a level is one pass over blocks of rows (see ``histograms``). One that can have at most
``DRIVER_CELLS`` cells, by the number of cuts and of nodes of the deepest level, goes to the driver, which finds the best
split of each node in it. Beyond that tasks find the splits by position, so that the driver gets a row per open node and
task, however wide the vectors are. Both give the same trees.

Blocks, with bins and margin, are written once a round, which cuts the lineage: a lost executor repeats a part of one round.
Rows and features are sampled by hashes, so that runs agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from math import log
from multiprocessing.pool import ThreadPool
from threading import Lock

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasSeed,
    HasStepSize,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.operators.encode import vector_arrays
from clickcast.operators.histograms import Block, Layout, Pass, Rule, Tree, drawn, level_splits, moved, pack
from clickcast.session import empty_folder, scratch_path, session_beside

# Cells of a level's histogram that the driver takes, of 28 bytes each.
DRIVER_CELLS = 500_000
# Fits of ``fitMultiple`` at the same time.
FITS = 2
# Blocks are written a few to a row group and each in a page of its own, and sent to Python a few at a time: a task holds
# so many of them, however many its partition has.
FILE_OPTIONS = {
    "parquet.block.row.count.limit": 8, "parquet.page.row.count.limit": 1, "parquet.page.size.row.check.min": 1,
    "parquet.enable.dictionary": "false",
}
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _param(name: str, text: str, kind=TypeConverters.toFloat) -> Param:
    return Param(Params._dummy(), name, text, kind)


class _Settings(
    HasLabelCol, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasMaxIter, HasStepSize, HasSeed
):
    maxDepth = _param("maxDepth", "splits from the root to a leaf", TypeConverters.toInt)
    maxBins = _param("maxBins", "cuts of a feature with several values", TypeConverters.toInt)
    minChildWeight = _param("minChildWeight", "least sum of second derivatives on either side of a split")
    subsample = _param("subsample", "share of the rows each tree learns from")
    colsampleByTree = _param("colsampleByTree", "share of the features each tree may split on")
    colsampleByLevel = _param("colsampleByLevel", "share of those that each level may split on")
    baseScore = _param("baseScore", "the probability every row starts from")
    l2 = _param("l2", "what is added to second derivatives")


@dataclass(frozen=True)
class Derivatives:
    """First and second derivatives of the logistic loss at the margins, and the rows a tree learns from.

    A row without a label has no first derivative.
    """

    seed: int
    turn: int
    share: float

    def __call__(self, tree: int, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        p = 1 / (1 + np.exp(-block.state))
        kept = drawn(self.seed, self.turn, block.row) < self.share if self.share < 1 else None
        return np.where(np.isnan(block.y), 0.0, p - block.y), p * (1 - p), kept


def feature_cuts(df: DataFrame, features: str, bins: int) -> tuple[DataFrame, dict[int, list[float]]]:
    """Every feature's least value besides zero, as a table, and the cuts of those features that have several.

    The latter are numeric columns: as many as the table has, not as it has labels.
    """
    spark, v = df.sparkSession, vector_arrays(df, features)
    places = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    long = df.select(F.inline(F.arrays_zip(places.alias("position"), v["values"].alias("value")))).filter("value <> 0")
    path = scratch_path(spark, "feature-values")
    long.groupBy("position").agg(F.min("value").alias("least"), F.max("value").alias("most")).write.parquet(path)
    stats = spark.read.parquet(path)
    wrong = stats.filter("least < 0").limit(1).collect()
    if wrong:
        raise ValueError(f"negative feature value at position {wrong[0]['position']}")
    several = stats.filter("least < most").select("position")
    quantiles = F.percentile_approx("value", [i / bins for i in range(bins)], 100 * bins)
    found = long.join(several, "position", "left_semi").groupBy("position").agg(quantiles.alias("cuts"))
    return stats, {r["position"]: sorted(set(r["cuts"])) for r in found.collect()}


def _written(rows: DataFrame, spark: SparkSession) -> tuple[DataFrame, str]:
    path = scratch_path(spark, "boosting-rows")
    rows.write.options(**FILE_OPTIONS).parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


@dataclass
class _Packed:
    """The blocks that ``fits`` fits begin with, in a session of their own, and what is known of the features."""

    spark: SparkSession
    stats: DataFrame
    layout: Layout
    cells: int
    start: float
    blocks: DataFrame
    path: str
    fits: int
    lock: Lock = field(default_factory=Lock)

    def drop(self) -> None:
        """A fit needs the blocks no more; the last removes them."""
        with self.lock:
            self.fits -= 1
            if not self.fits:
                empty_folder(self.spark, self.path)


def _margins(trees: list[Tree], start: float) -> Callable[[pa.Array], pa.Array]:
    """The margins of vectors: a row goes left where the value of the node's position is below its threshold."""
    shapes = [tuple(map(np.array, (t.position, t.threshold, t.value))) for t in trees]
    used = np.unique(np.concatenate([p[p >= 0] for p, _, _ in shapes])) if trees else np.zeros(0)

    def margins(vectors: pa.Array) -> pa.Array:
        kind, places, values = (vectors.field(c) for c in ("type", "indices", "values"))
        size = np.asarray(values.value_lengths().fill_null(0))
        owner, value = np.repeat(np.arange(len(vectors)), size), np.asarray(values.flatten())
        place = np.arange(len(value)) - np.repeat(np.cumsum(size) - size, size)
        sparse = np.asarray(kind) == 0
        place[sparse[owner]] = np.asarray(places.filter(pa.array(sparse)).flatten())
        at = np.flatnonzero(np.isin(place, used))
        place, value, owner = place[at], value[at], owner[at]
        found = np.full(len(vectors), start)
        for tree, (position, threshold, add) in zip(trees, shapes, strict=True):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(tree.depth):
                on, right = node[owner], np.zeros(len(node), np.int64)
                right[owner[(place == position[on]) & (value >= threshold[on])]] = 1
                node = np.where(position[node] >= 0, 2 * node + 1 + right, node)
            found += add[node]
        return pa.array(found)

    return margins


class SecondOrderBoosting(Estimator, _Settings):
    """See the module. ``fitMultiple`` fits points that differ in the number of rounds only once, to the longest."""

    # What learns from a table of its own reads the rows a few times; kept in memory, they leave executors too little.
    own_table = True

    @keyword_only
    def __init__(
        self, *, maxIter: int = 20, stepSize: float = 0.1, maxDepth: int = 6, maxBins: int = 64, minChildWeight: float = 1.0,
        subsample: float = 1.0, colsampleByTree: float = 1.0, colsampleByLevel: float = 1.0, baseScore: float = 0.5,
        l2: float = 1.0, seed: int = 0, labelCol: str = "label", featuresCol: str = "features",
    ):
        super().__init__()
        self._setDefault(
            maxIter=20, stepSize=0.1, maxDepth=6, maxBins=64, minChildWeight=1.0, subsample=1.0, colsampleByTree=1.0,
            colsampleByLevel=1.0, baseScore=0.5, l2=1.0, seed=0,
        )
        self._set(**self._input_kwargs)

    def fitMultiple(self, dataset, paramMaps):
        points = [self.copy(p) for p in paramMaps]
        longest: dict[tuple, SecondOrderBoosting] = {}
        for p in points:
            if p._but_rounds() not in longest or longest[p._but_rounds()].getMaxIter() < p.getMaxIter():
                longest[p._but_rounds()] = p
        # Fits with the same bins and the same start begin with the same blocks.
        packing = [p._packing() for p in longest.values()]
        packed = {at: p._packed(dataset, packing.count(at)) for at, p in dict(zip(packing, longest.values(), strict=True)).items()}
        # A pass over one level leaves cores idle between its tasks and the next pass.
        fit = inheritable_thread_target(dataset.sparkSession)(lambda p: p._boosted(packed[p._packing()]))
        with ThreadPool(max(1, min(FITS, len(longest)))) as pool:
            fitted = dict(zip(longest, pool.map(fit, longest.values()), strict=True))
        return iter([(i, p._copyValues(fitted[p._but_rounds()].first(p.getMaxIter()))) for i, p in enumerate(points)])

    def _but_rounds(self) -> tuple:
        return tuple(sorted((p.name, self.getOrDefault(p)) for p in self.params if p.name != "maxIter" and self.isDefined(p)))

    def _packing(self) -> tuple:
        return tuple(self.getOrDefault(p) for p in ("featuresCol", "labelCol", "maxBins", "baseScore"))

    def _fit(self, dataset: DataFrame) -> SecondOrderBoostingModel:
        return self._boosted(self._packed(dataset))

    def _packed(self, dataset: DataFrame, fits: int = 1) -> _Packed:
        get = self.getOrDefault
        spark, features = dataset.sparkSession, self.getFeaturesCol()
        stats, cuts = feature_cuts(dataset, features, get("maxBins"))
        start = log(get("baseScore") / (1 - get("baseScore")))
        layout = Layout((stats.agg(F.max("position")).first()[0] or 0) + 1, cuts)
        beside = session_beside(spark, BATCHES)
        blocks, path = _written(pack(dataset, features, self.getLabelCol(), layout, start), beside)
        return _Packed(beside, stats, layout, stats.count() + sum(map(len, cuts.values())), start, blocks, path, fits)

    def _boosted(self, rows: _Packed) -> SecondOrderBoostingModel:
        get, spark, layout = self.getOrDefault, rows.spark, rows.layout
        on_driver = rows.cells * 2 ** (get("maxDepth") - 1) <= DRIVER_CELLS
        trees: list[Tree] = []
        blocks, path = rows.blocks, None
        for turn in range(get("maxIter")):
            trees.append(self._tree(blocks, layout, turn, on_driver))
            if turn + 1 < get("maxIter"):
                old = path
                blocks, path = _written(moved(blocks, layout, trees[-1]), spark)
                rows.drop() if old is None else empty_folder(spark, old)
        rows.drop() if path is None else empty_folder(spark, path)
        self._set_thresholds(trees, rows.stats, layout.cuts)
        return self._copyValues(SecondOrderBoostingModel(trees, rows.start))

    def _tree(self, blocks: DataFrame, layout: Layout, turn: int, on_driver: bool) -> Tree:
        get = self.getOrDefault
        tree, value = Tree(get("maxDepth")), lambda g, h: -g / (h + get("l2")) * get("stepSize")
        target = Derivatives(get("seed"), turn, get("subsample"))
        # The open nodes and their sums, which are known behind the root.
        open_, sums = [0], None
        for level in range(get("maxDepth")):
            shares = {"tree": get("colsampleByTree"), str(level): get("colsampleByLevel")}
            shares = {of: share for of, share in shares.items() if share < 1}
            rule = Rule(get("l2"), get("minChildWeight"), shares, get("seed"), turn)
            work = Pass(layout, {0: tree}, [(0, n) for n in open_], target)
            splits, sums = level_splits(blocks, work, rule, sums, on_driver)
            if not level:
                tree.value[0] = value(*sums[0, :2].tolist())
            found, open_, below = open_, [], []
            for slot, (_, position, cut, rg, rh) in sorted(splits.items()):
                n, (sg, sh) = found[slot], sums[slot, :2].tolist()
                tree.position[n], tree.cut[n] = position, cut
                for child, g, h in ((2 * n + 1, sg - rg, sh - rh), (2 * n + 2, rg, rh)):
                    tree.value[child] = value(g, h)
                    open_.append(child)
                    below.append((g, h))
            if not open_:
                break
            sums = np.array(below)
        return tree

    @staticmethod
    def _set_thresholds(trees: list[Tree], stats: DataFrame, cuts: dict[int, list[float]]) -> None:
        """Cuts as values, for rows that have no bins: of features with one value, that value."""
        used = {p for t in trees for p in t.position if p >= 0 and p not in cuts}
        least = {r["position"]: r["least"] for r in stats.filter(F.col("position").isin(*used)).collect()} if used else {}
        for t in trees:
            t.threshold = [
                0.0 if p < 0 else cuts[p][c - 1] if p in cuts else least[p] for p, c in zip(t.position, t.cut, strict=True)
            ]


class SecondOrderBoostingModel(Model, _Settings):
    """``trees`` and the margin ``start`` that they are added to."""

    def __init__(self, trees: list[Tree], start: float):
        super().__init__()
        self.trees, self.start = trees, start

    def first(self, rounds: int) -> SecondOrderBoostingModel:
        """The model after so many rounds."""
        return SecondOrderBoostingModel(self.trees[:rounds], self.start)

    def _with_margin(self, df: DataFrame) -> DataFrame:
        added = F.arrow_udf(_margins(self.trees, self.start), "double")
        return df.withColumn("_margin", added(vector_arrays(df, self.getFeaturesCol())))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = self._with_margin(dataset)
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return rows.withColumns(
            {
                self.getRawPredictionCol(): array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
                self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
                self.getPredictionCol(): (F.col("_margin") > 0).cast("double"),
            }
        ).drop("_margin")

    def save(self, spark: SparkSession, path: str) -> None:
        """A row per tree, and the start with each. Replaces what is there."""
        rows = [(i, t.depth, t.position, t.cut, t.threshold, t.value, self.start) for i, t in enumerate(self.trees)]
        kinds = "tree int, depth int, position array<int>, cut array<int>, threshold array<double>, value array<double>, start double"
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> SecondOrderBoostingModel:
        rows = spark.read.parquet(path).orderBy("tree").collect()
        trees = [Tree(r["depth"], r["position"], r["cut"], r["threshold"], r["value"]) for r in rows]
        return SecondOrderBoostingModel(trees, rows[0]["start"])
