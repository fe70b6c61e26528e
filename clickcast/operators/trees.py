"""Spark's trees, forests and boosted trees, learnt from wide sparse vectors without a number per feature and row.

Spark's learner turns every row into an array of as many bins as the vector is wide: with a feature per address, rows times
addresses. Where vectors have more than ``WIDE_VECTOR`` positions, these estimators learn from the entries that are not zero
instead (see ``histograms``). The tree is that of Spark's method: the split that takes most off the Gini impurity, or off the
variance in boosted trees, of equal ones the lowest position and cut; leaves beside each other that predict the same are one.
Every label counts as a split, where Spark looks for splits in a sample of rows, and a feature with several values is cut at
``maxBins - 1`` quantiles of those besides zero. The model is Spark's own.

Narrow vectors, labels other than 0 and 1, negative values and settings that are not among those below go to Spark's learner.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil, log2, sqrt

import numpy as np
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickcast.operators.boosting import DRIVER_CELLS, feature_cuts
from clickcast.operators.encode import vector_arrays
from clickcast.operators.histograms import TASK_CELLS, Block, Layout, Pass, Rule, Tree, drawn, level_splits, moved, pack, totals
from clickcast.session import empty_folder, scratch_path

# Vectors with more positions than this are learnt from by their entries.
WIDE_VECTOR = 1000
# Poisson counts of a bootstrap stop here; the chance of more is below 1e-18 at a mean of 1.
MOST_COPIES = 20


@dataclass(frozen=True)
class Classes:
    """Label 1 and rows, which a bootstrap counts as often as it has drawn them."""

    seed: int
    share: float
    again: bool

    def __call__(self, tree: int, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        if not self.again and self.share >= 1:
            return -block.y, np.ones(len(block.y)), None
        copies = _copies(self.seed, tree, block, self.share, self.again)
        return -block.y * copies, copies, copies > 0


def _copies(seed: int, tree: int, block: Block, share: float, again: bool) -> np.ndarray:
    draw = drawn(seed, tree, block.row)
    if not again:
        return (draw < share).astype(np.float64)
    chances = np.exp(-share) * np.cumprod([1.0, *(share / k for k in range(1, MOST_COPIES))])
    return np.searchsorted(np.cumsum(chances), draw, side="right").astype(np.float64)


@dataclass(frozen=True)
class Residuals:
    """What is left of the labels -1 and 1 after the trees so far: the labels themselves, then the loss's slope."""

    seed: int
    turn: int
    share: float

    def __call__(self, tree: int, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        y = 2 * block.y - 1
        left = y if self.turn == 0 else 4 * y / (1 + np.exp(2 * y * block.state))
        kept = drawn(self.seed, self.turn, block.row) < self.share if self.share < 1 else None
        return -left, np.ones(len(y)), kept


def features_per_node(strategy: str, width: int, trees: int) -> int | None:
    """How many positions a node may split on, by the names Spark has for it; None for all."""
    if strategy == "auto":
        strategy = "sqrt" if trees > 1 else "all"
    named = {"all": width, "sqrt": ceil(sqrt(width)), "log2": max(1, ceil(log2(width))), "onethird": ceil(width / 3)}
    if strategy in named:
        found = named[strategy]
    elif strategy.isdigit():
        found = min(int(strategy), width)
    else:
        found = ceil(float(strategy) * width)
    return None if found >= width else found


@dataclass
class Grown:
    """A tree with the sums of each node: minus the targets', the rows' and the squares'; gains by node."""

    tree: Tree
    sums: dict[int, tuple[float, float, float]]
    gain: dict[int, float]


def grow(
    blocks: DataFrame, layout: Layout, cells: int, names: list[int], target: Callable, depth: int, least: float,
    features: int | None, seed: int, squares: bool = False,
) -> dict[int, Grown]:
    """The trees ``names``, a level of all of them in a pass as long as a task's sums have room for their nodes."""
    grown = {t: Grown(Tree(depth), {}, {}) for t in names}
    room = max(1, TASK_CELLS // layout.size)
    open_ = [(t, 0) for t in names]
    rule = Rule(least=least)
    for level in range(depth + 1):
        if level == depth and not (squares and open_) and level:
            break
        below = []
        # Nodes of one tree stay in one pass: its rows are sent down once.
        parts: list[list[tuple[int, int]]] = [[]]
        for t in dict.fromkeys(t for t, _ in open_):
            own = [slot for slot in open_ if slot[0] == t]
            if parts[-1] and len(parts[-1]) + len(own) > room:
                parts.append([])
            parts[-1] += own
        for slots in filter(None, parts):
            work = Pass(layout, {t: grown[t].tree for t in dict.fromkeys(t for t, _ in slots)}, slots, target, features, seed)
            if level == depth:
                splits, sums = {}, totals(blocks, work)
            else:
                known = None if squares or not level else np.array([grown[t].sums[n] for t, n in slots])
                splits, sums = level_splits(blocks, work, rule, known, cells * len(slots) <= DRIVER_CELLS)
            for (t, n), found in zip(slots, sums.tolist(), strict=True):
                grown[t].sums[n] = tuple(found)
                grown[t].tree.value[n] = -found[0] / found[1] if found[1] else 0.0
            for slot, (gain, position, cut, rg, rh) in sorted(splits.items()):
                (t, n), (sg, sh, _) = slots[slot], sums[slot].tolist()
                own = grown[t]
                own.tree.position[n], own.tree.cut[n], own.gain[n] = position, cut, gain
                for child, g, h in ((2 * n + 1, sg - rg, sh - rh), (2 * n + 2, rg, rh)):
                    own.sums[child], own.tree.value[child] = (g, h, 0.0), -g / h
                    below.append((t, child))
        open_ = below
        if not open_:
            break
    return grown


class _Nodes:
    """Grown trees as Spark's."""

    def __init__(self, spark: SparkSession, regression: bool):
        self.spark, self.regression = spark, regression
        self.ml, self.impurity = spark._jvm.org.apache.spark.ml, spark._jvm.org.apache.spark.mllib.tree.impurity

    def array(self, kind, values):
        made = self.spark.sparkContext._gateway.new_array(kind, len(values))
        for i, v in enumerate(values):
            made[i] = v
        return made

    def root(self, grown: Grown, n: int = 0):
        tree, (g, h, q) = grown.tree, grown.sums[n]
        stats = (h, -g, q) if self.regression else (h + g, -g)
        calculator = self.impurity.VarianceCalculator if self.regression else self.impurity.GiniCalculator
        stats = calculator(self.array(self.spark._jvm.double, list(map(float, stats))), round(h))
        if tree.position[n] < 0:
            return self.ml.tree.LeafNode(stats.predict(), stats.calculate(), stats)
        left, right = self.root(grown, 2 * n + 1), self.root(grown, 2 * n + 2)
        if left.numDescendants() == right.numDescendants() == 0 and left.prediction() == right.prediction():
            return self.ml.tree.LeafNode(left.prediction(), stats.calculate(), stats)
        split = self.ml.tree.ContinuousSplit(tree.position[n], tree.threshold[n])
        # Half the loss of Gini impurity, or the loss of variance, by row.
        gain = grown.gain[n] / h * (1 if self.regression else 2)
        return self.ml.tree.InternalNode(stats.predict(), stats.calculate(), gain, left, right, split, stats)


@dataclass
class _Learner:
    """The rows in blocks and what is known of their features."""

    spark: SparkSession
    layout: Layout
    stats: DataFrame
    blocks: DataFrame
    path: str
    cells: int

    def stored(self, blocks: DataFrame) -> None:
        path, old = scratch_path(self.spark, "tree-rows"), self.path
        blocks.write.parquet(path)
        self.blocks, self.path = self.spark.read.schema(blocks.schema).parquet(path), path
        if old:
            empty_folder(self.spark, old)

    def set_thresholds(self, trees: list[Tree]) -> None:
        """Spark's rows go left up to the threshold: half of a single value, else the next number below the cut."""
        cuts = self.layout.cuts
        used = sorted({p for t in trees for p in t.position if p >= 0 and p not in cuts})
        asked = self.spark.createDataFrame([(p,) for p in used], "position int")
        least = {r["position"]: r["least"] for r in self.stats.join(F.broadcast(asked), "position", "left_semi").collect()}
        for t in trees:
            t.threshold = [
                0.0 if p < 0 else float(np.nextafter(cuts[p][c - 1], -np.inf)) if p in cuts else least[p] / 2
                for p, c in zip(t.position, t.cut, strict=True)
            ]


class _Wide:
    """What the three estimators below share: whether to learn by entries, and from what."""

    # What may be set to other values than these only for Spark's learner.
    fixed = {"minInfoGain": 0.0, "minWeightFractionPerNode": 0.0}

    def _learner(self, dataset: DataFrame) -> _Learner | None:
        get, features, label = self.getOrDefault, self.getFeaturesCol(), self.getLabelCol()
        unset = ("weightCol", "thresholds", "validationIndicatorCol")
        if any(self.hasParam(p) and self.isDefined(p) for p in unset) or any(get(p) != v for p, v in self.fixed.items()):
            return None
        v = vector_arrays(dataset, features)
        first = dataset.select(F.when(v["type"] == 0, v["size"]).otherwise(F.size(v["values"])).alias("n")).first()
        if first is None or first["n"] is None or first["n"] <= WIDE_VECTOR:
            return None
        y = F.col(label).cast("double")
        others = F.count_if(y.isNull() | ~y.isin(0.0, 1.0)).alias("others")
        labels = dataset.agg(others, F.max(y).alias("most")).first()
        if labels["others"] or labels["most"] == 0 and not isinstance(self, GBTClassifier):
            return None
        try:
            stats, cuts = feature_cuts(dataset, features, get("maxBins") - 1)
        except ValueError:
            return None
        layout = Layout(first["n"], cuts)
        learner = _Learner(dataset.sparkSession, layout, stats, dataset, "", stats.count() + sum(map(len, cuts.values())))
        learner.stored(pack(dataset, features, label, layout, 0.0))
        return learner

    def _seed(self) -> int:
        return self.getSeed() & 0x7FFFFFFF

    def _made(self, model, learner: _Learner):
        empty_folder(learner.spark, learner.path)
        return self._copyValues(model)


class WideDecisionTree(_Wide, DecisionTreeClassifier):
    fixed = {**_Wide.fixed, "impurity": "gini"}

    def _fit(self, dataset: DataFrame):
        learner = self._learner(dataset)
        if learner is None:
            return super()._fit(dataset)
        get = self.getOrDefault
        target = Classes(self._seed(), 1.0, False)
        grown = grow(
            learner.blocks, learner.layout, learner.cells, [0], target, get("maxDepth"), get("minInstancesPerNode"), None, self._seed()
        )[0]
        learner.set_thresholds([grown.tree])
        nodes = _Nodes(learner.spark, False)
        made = nodes.ml.classification.DecisionTreeClassificationModel(self.uid, nodes.root(grown), learner.layout.width, 2)
        return self._made(DecisionTreeClassificationModel(made), learner)


class WideRandomForest(_Wide, RandomForestClassifier):
    fixed = {**_Wide.fixed, "impurity": "gini"}

    def _fit(self, dataset: DataFrame):
        learner = self._learner(dataset)
        if learner is None:
            return super()._fit(dataset)
        get, count, width = self.getOrDefault, self.getNumTrees(), learner.layout.width
        target = Classes(self._seed(), get("subsamplingRate"), get("bootstrap") and (count > 1 or get("subsamplingRate") < 1))
        features = features_per_node(get("featureSubsetStrategy"), width, count)
        grown = grow(
            learner.blocks, learner.layout, learner.cells, list(range(count)), target, get("maxDepth"),
            get("minInstancesPerNode"), features, self._seed(),
        )
        learner.set_thresholds([g.tree for g in grown.values()])
        nodes = _Nodes(learner.spark, False)
        kind = nodes.ml.classification.DecisionTreeClassificationModel
        trees = nodes.array(kind, [kind(f"{self.uid}_{i}", nodes.root(g), width, 2) for i, g in grown.items()])
        made = nodes.ml.classification.RandomForestClassificationModel(self.uid, trees, width, 2)
        return self._made(RandomForestClassificationModel(made), learner)


class WideBoostedTrees(_Wide, GBTClassifier):
    fixed = {**_Wide.fixed, "impurity": "variance", "lossType": "logistic"}

    def _fit(self, dataset: DataFrame):
        learner = self._learner(dataset)
        if learner is None:
            return super()._fit(dataset)
        get, width = self.getOrDefault, learner.layout.width
        features = features_per_node(get("featureSubsetStrategy"), width, 1)
        found, weights = [], []
        for turn in range(get("maxIter")):
            target = Residuals(self._seed(), turn, get("subsamplingRate"))
            grown = grow(
                learner.blocks, learner.layout, learner.cells, [turn], target, get("maxDepth"), get("minInstancesPerNode"),
                features, self._seed(), squares=True,
            )[turn]
            found.append(grown)
            weights.append(get("stepSize") if turn else 1.0)
            if turn + 1 < get("maxIter"):
                learner.stored(moved(learner.blocks, learner.layout, grown.tree, weights[-1]))
        learner.set_thresholds([g.tree for g in found])
        nodes = _Nodes(learner.spark, True)
        kind = nodes.ml.regression.DecisionTreeRegressionModel
        trees = nodes.array(kind, [kind(f"{self.uid}_{i}", nodes.root(g), width) for i, g in enumerate(found)])
        of = nodes.array(learner.spark._jvm.double, weights)
        made = nodes.ml.classification.GBTClassificationModel(self.uid, trees, of, width, 2)
        return self._made(GBTClassificationModel(made), learner)
