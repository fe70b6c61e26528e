"""Train/validation search over a parameter grid."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from clickcast.functions import hash_split
from clickcast.operators.evaluate import LabelAUROC
from clickcast.operators.models import classifier


@dataclass(frozen=True)
class Tuned:
    """The model refitted on all rows with the best parameters, and the metric of every grid point."""

    model: Model
    metrics: list[float]
    grid: Sequence[dict]

    @property
    def best(self) -> dict:
        """The winning parameters by name; of equal ones the first."""
        return {p.name: v for p, v in self.grid[self.metrics.index(max(self.metrics))].items()}


def tune(
    train: DataFrame,
    estimator: Estimator,
    grid: Sequence[dict],
    evaluator: Evaluator | None = None,
    ratio: float = 0.8,
    seed: int = 0,
    parallelism: int = 4,
    split: str = "random",
    key: str | None = None,
) -> Tuned:
    """Fit each grid point on one part of ``train``, score it on the other, and refit the best on all of it.

    ``split="random"`` samples rows with ``seed``. ``split="hash"`` splits on the md5 of ``key``, to a tenth, so that the
    parts do not depend on the partitioning.
    """
    evaluator = evaluator or LabelAUROC()
    if split == "random":
        fitted = TrainValidationSplit(
            estimator=estimator,
            estimatorParamMaps=list(grid),
            evaluator=evaluator,
            trainRatio=ratio,
            seed=seed,
            parallelism=parallelism,
        ).fit(train)
        return Tuned(fitted.bestModel, list(fitted.validationMetrics), grid)
    if split != "hash":
        raise ValueError(f"unknown split {split!r}")

    tenths = round(10 * ratio)
    if abs(10 * ratio - tenths) > 1e-9:
        raise ValueError(f"a hash split is to a tenth; {ratio} is not")
    # Other digits than a train/test split on the same key uses, so that the two are independent.
    learn, check = parts = hash_split(train, key, tenths, 1)
    kept = () if getattr(estimator, "own_table", False) else parts
    for part in kept:
        part.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # An estimator that can fit several points at once does so; others fit one per step of this iterator.
        models = estimator.fitMultiple(learn, list(grid))

        def score(_) -> tuple[int, float]:
            point, model = next(models)
            return point, evaluator.evaluate(model.transform(check))

        with ThreadPool(min(parallelism, len(grid))) as pool:
            scored = dict(pool.map(inheritable_thread_target(train.sparkSession)(score), grid))
        metrics = [scored[i] for i in range(len(grid))]
    finally:
        for part in kept:
            part.unpersist()
    best = grid[metrics.index(max(metrics))]
    return Tuned(estimator.fit(train, best), metrics, grid)


def fit(
    train: DataFrame, algorithm: str, params: dict | None = None, seed: int | None = None, persist: bool = True, **tuning
) -> Tuned | Model:
    """Fit a registered classifier on ``label, features``: with fixed ``params`` if given, else tuned over its grid.

    Without a ``seed`` the classifier's own is used. With ``persist`` the training rows are kept in memory, or on disk where they do not fit, for the passes the fit makes
    over them. Rows that are read from a file as they stand gain little from a second copy.
    """
    chosen = classifier(algorithm)
    seed = chosen.seed if seed is None else seed
    estimator = chosen.make(seed)
    if persist:
        train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if params is not None or not chosen.grid:
            named = {estimator.getParam(chosen.names.get(k, k)): v for k, v in (params or {}).items()}
            return estimator.fit(train, named)
        return tune(train, estimator, chosen.param_grid(estimator), seed=seed, **tuning)
    finally:
        if persist:
            train.unpersist()
