"""The classifiers, each with its settings and its tuning grid. All learn from ``label`` and ``features``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.tuning import ParamGridBuilder

from clickcast.operators.bayes import TableNaiveBayes
from clickcast.operators.boosting import SecondOrderBoosting
from clickcast.operators.trees import WideBoostedTrees, WideDecisionTree, WideRandomForest

# Settings of the boosted model, under their usual names.
BOOSTED = {
    "objective": "binary:logistic",
    "eta": 0.1,
    "max_depth": 6,
    "min_child_weight": 3.0,
    "subsample": 0.8,
    "colsample_bytree": 0.82,
    "colsample_bylevel": 0.9,
    "base_score": 0.005,
    "eval_metric": "auc",
    "seed": 49,
    "nWorkers": 2,
}
# What each model is tuned over.
GRIDS = {
    "rf": {"numTrees": [10, 30, 100]},
    "gbt": {"maxIter": [10, 30], "maxDepth": [2, 5]},
    "lr": {"regParam": [0.1, 0.01], "elasticNetParam": [0.0, 0.8]},
    "nb": {"smoothing": [0.0, 0.5, 1.0]},
    "boosted": {"round": [20, 50], "eta": [0.1, 0.4]},
}


def second_order(seed: int = BOOSTED["seed"]) -> Estimator:
    """Boosting by second derivatives with all settings of ``BOOSTED`` that say what is learned.

    ``objective`` is the only one there is, ``eval_metric`` is what tuning is given, and ``nWorkers`` is Spark's business.
    """
    return SecondOrderBoosting(
        stepSize=BOOSTED["eta"],
        maxIter=GRIDS["boosted"]["round"][0],
        maxDepth=BOOSTED["max_depth"],
        minChildWeight=BOOSTED["min_child_weight"],
        subsample=BOOSTED["subsample"],
        colsampleByTree=BOOSTED["colsample_bytree"],
        colsampleByLevel=BOOSTED["colsample_bylevel"],
        baseScore=BOOSTED["base_score"],
        seed=seed,
    )


def boosted_trees(seed: int = BOOSTED["seed"]) -> Estimator:
    """Gradient boosting by Spark's own boosted trees, with those settings of ``BOOSTED`` that have an equal there.

    ``eta`` is the step size, ``round`` the number of iterations, ``subsample`` and ``colsample_bytree`` the sampling of
    rows and, per node, of features. ``min_child_weight`` is a sum of second derivatives, for which the least number of rows
    per node is the nearest; ``colsample_bylevel`` and ``base_score`` are left out. ``second_order`` has all three.
    """
    return WideBoostedTrees(
        stepSize=BOOSTED["eta"],
        maxIter=GRIDS["boosted"]["round"][0],
        maxDepth=BOOSTED["max_depth"],
        minInstancesPerNode=int(BOOSTED["min_child_weight"]),
        subsamplingRate=BOOSTED["subsample"],
        featureSubsetStrategy=str(BOOSTED["colsample_bytree"]),
        seed=seed,
    )


@dataclass(frozen=True)
class Classifier:
    """``make(seed)`` gives the estimator; ``names`` maps grid names to the estimator's own, where they differ."""

    make: Callable[[int], Estimator]
    grid: dict
    names: dict
    seed: int = 0

    def param_grid(self, estimator: Estimator) -> list:
        """The cross product of the value lists, as parameter maps; one empty map if there is nothing to tune."""
        builder = ParamGridBuilder()
        for name, values in self.grid.items():
            builder.addGrid(estimator.getParam(self.names.get(name, name)), values)
        return builder.build()


REGISTRY: dict[str, Classifier] = {
    "dt": Classifier(lambda seed: WideDecisionTree(seed=seed), {}, {}),
    "rf": Classifier(lambda seed: WideRandomForest(seed=seed), GRIDS["rf"], {}),
    "gbt": Classifier(lambda seed: WideBoostedTrees(maxIter=10, seed=seed), GRIDS["gbt"], {}),
    "lr": Classifier(lambda seed: LogisticRegression(maxIter=10), GRIDS["lr"], {}),
    # The parameters as a table; ``nb_vector`` holds a number per feature and class on the driver.
    "nb": Classifier(lambda seed: TableNaiveBayes(), GRIDS["nb"], {}),
    "nb_vector": Classifier(lambda seed: NaiveBayes(), GRIDS["nb"], {}),
    "boosted": Classifier(second_order, GRIDS["boosted"], {"round": "maxIter", "eta": "stepSize"}, BOOSTED["seed"]),
    "boosted_gbt": Classifier(boosted_trees, GRIDS["boosted"], {"round": "maxIter", "eta": "stepSize"}, BOOSTED["seed"]),
}


def classifier(name: str) -> Classifier:
    if name not in REGISTRY:
        raise ValueError(f"unknown classifier {name!r}; known: {', '.join(REGISTRY)}")
    return REGISTRY[name]
