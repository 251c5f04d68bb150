"""Quality of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(predictions: DataFrame, label: str = "label") -> DataFrame:
    """One row: size of the test set and the share of correct predictions."""
    correct = (F.col(label).cast("double") == F.col("prediction")).cast("double")
    return predictions.agg(F.count(F.lit(1)).alias("n"), F.avg(correct).alias("accuracy"))


def confusion_counts(predictions: DataFrame, label: str = "label") -> DataFrame:
    return predictions.groupBy(label, "prediction").agg(F.count(F.lit(1)).alias("n"))


def quality(predictions: DataFrame, label: str = "label") -> DataFrame:
    """One row with all four counts and accuracy, in one pass over the predictions."""

    def counted(actual: int, predicted: int):
        return F.count_if((F.col(label) == actual) & (F.col("prediction") == predicted))

    correct = (F.col(label).cast("double") == F.col("prediction")).cast("double")
    return predictions.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.avg(correct).alias("accuracy"),
        counted(1, 1).alias("true_positives"),
        counted(0, 1).alias("false_positives"),
        counted(1, 0).alias("false_negatives"),
        counted(0, 0).alias("true_negatives"),
    )
