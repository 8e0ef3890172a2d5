"""Saving and loading a fitted forecaster together with its name and feature lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Row, SparkSession

from demandspark import schemas


@dataclass
class SavedForecaster:
    name: str
    categorical: list[str]
    numerical: list[str]
    model: PipelineModel


def save_forecaster(name: str, model: PipelineModel, path: str) -> None:
    """Encoding, scaling and regression are stages of one pipeline and saved as one."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    card = Row(
        name=name,
        categorical=schemas.CATEGORICAL_FEATURES,
        numerical=schemas.NUMERICAL_FEATURES,
    )
    spark.createDataFrame([card]).coalesce(1).write.mode("overwrite").json(f"{path}/card")


def load_forecaster(spark: SparkSession, path: str) -> SavedForecaster:
    schema = "name string, categorical array<string>, numerical array<string>"
    card = spark.read.schema(schema).json(f"{path}/card").first()
    return SavedForecaster(
        card.name, card.categorical, card.numerical, PipelineModel.load(f"{path}/model")
    )
