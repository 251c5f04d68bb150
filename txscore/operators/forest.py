"""Random forest over the feature vector."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame

from txscore.operators.features import FEATURES

# fixed value: bins per feature
MAX_BINS = 700
TREES = 20
DEPTH = 5


def fit_forest(
    df: DataFrame,
    label: str = "label",
    weight: str | None = None,
    max_bins: int = MAX_BINS,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = 42,
) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        maxBins=max_bins,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
    )
    if weight:
        forest = forest.setWeightCol(weight)
    # the copy leaves the training summary behind: it holds the session, which cannot be sent
    # to tasks once the session has observed metrics
    return forest.fit(df).copy()


def score(
    df: DataFrame, preprocessor: PipelineModel, forest: RandomForestClassificationModel
) -> DataFrame:
    """The input columns plus `prediction`; vectors and intermediate columns are dropped."""
    kept = df.columns
    return forest.transform(preprocessor.transform(df)).select(*kept, "prediction")
