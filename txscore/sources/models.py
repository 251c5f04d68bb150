"""Saved models, one folder per version."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import SparkSession

from txscore.settings import Settings
from txscore.sources.tables import commit_version, latest_version

MODEL_NAME = "models"


def save_models(
    spark: SparkSession,
    cfg: Settings,
    preprocessor: PipelineModel,
    forest: RandomForestClassificationModel,
    version: str,
) -> None:
    """Save both models, then commit the version; an unfinished save can simply run again."""
    preprocessor.write().overwrite().save(f"{cfg.preprocessor_path}/{version}")
    forest.write().overwrite().save(f"{cfg.forest_path}/{version}")
    commit_version(spark, cfg, MODEL_NAME, version)


def load_models(
    cfg: Settings, version: str
) -> tuple[PipelineModel, RandomForestClassificationModel]:
    return (
        PipelineModel.load(f"{cfg.preprocessor_path}/{version}"),
        RandomForestClassificationModel.load(f"{cfg.forest_path}/{version}"),
    )


def newest_model_version(spark: SparkSession, cfg: Settings) -> str | None:
    return latest_version(spark, cfg, MODEL_NAME)
