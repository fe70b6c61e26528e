"""Area under the ROC curve, over hard 0/1 labels and over scores."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def auroc_label(df: DataFrame, prediction: str = "prediction", label: str = "label") -> float:
    """The area with the predicted class as the score: ``(1 + TPR - FPR) / 2``, from one aggregation.

    It says how good the decisions are, not how good the ranking is; see ``auroc_score``. With labels of one class only
    it is 1.0 for all-positive and 0.0 for all-negative. Predictions other than 0 and 1 are scores.
    """
    positive, flagged = F.col(label) > 0.5, F.col(prediction) == 1
    row = df.agg(
        F.count_if(positive).alias("p"),
        F.count_if(~positive).alias("n"),
        F.count_if(positive & flagged).alias("tp"),
        F.count_if(~positive & flagged).alias("fp"),
        F.count_if(~F.col(prediction).isin(0, 1)).alias("other"),
    ).first()
    if row["other"]:
        return auroc_score(df, prediction, label)
    if not row["p"]:
        return 0.0
    if not row["n"]:
        return 1.0
    return (1.0 + row["tp"] / row["p"] - row["fp"] / row["n"]) / 2.0


def auroc_score(df: DataFrame, score: str = "probability", label: str = "label") -> float:
    """The area over a score, a number or a vector whose second entry counts; ties count half.

    ``numBins=0`` keeps every distinct score. Rows are aggregated by score before the distributed sort.
    """
    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, numBins=0).evaluate(df)


class LabelAUROC(Evaluator):
    """``auroc_label`` for use in tuning."""

    def _evaluate(self, dataset: DataFrame) -> float:
        return auroc_label(dataset)

    def isLargerBetter(self) -> bool:
        return True
