"""Two-way routing by class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def of_class(df: DataFrame, value: int, label: str = "is_fraud") -> DataFrame:
    """Rows of one class without the label; a null label is in neither class."""
    return df.filter(F.col(label) == value).drop(label)


def class_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
