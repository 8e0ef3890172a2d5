"""Metrics, leaderboard and winner over a long table of predictions (model, y, yhat)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark import schemas
from demandspark.functions import columns as C


def evaluate(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE and MAPE per model, two decimals. For MAPE a target of zero counts as one."""
    y, error = F.col("y").cast("double"), F.col("y") - F.col("yhat")
    base = F.when(y == 0, F.lit(1.0)).otherwise(y)
    return predictions.groupBy("model").agg(
        F.bround(F.avg(F.abs(error)), 2).alias("mae"),
        F.bround(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        F.bround(F.avg(F.abs(error / base)) * 100, 2).alias("mape"),
    )


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("mae", "model")


def against_naive(metrics: DataFrame, naive: str = schemas.NAIVE) -> DataFrame:
    """The leaderboard with each model's ``rank`` and whether its error is below that of the naive forecast; null if
    that is not among them. One row per model, so one task orders them."""
    error = metrics.filter(F.col("model") == naive).agg(F.min("mae").alias("mae")).scalar()
    ranked = metrics.withColumn("rank", F.row_number().over(W.orderBy("mae", "model")))
    return ranked.withColumn("beats_naive", F.col("mae") < error).orderBy("rank")


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the lowest MAE, with its metrics and the reason as text."""
    winner = leaderboard(metrics).limit(1)
    figures = [F.col(c).cast("string") for c in ("mae", "rmse", "mape")]
    return winner.withColumn("rationale", F.format_string(schemas.RATIONALE, "model", *figures))


def wide_predictions(
    predictions: DataFrame, models: Mapping[str, str], n: int | None = 10
) -> DataFrame:
    """Actual and predicted values side by side; ``models`` maps a model to its column name.
    The first n rows by day, store and product, or all with ``n=None``."""
    keys = ["Date", "Store_ID", "Product_ID"]
    wide = predictions.groupBy(*keys).agg(
        F.max("y").alias("actual"),
        *[F.max(F.when(F.col("model") == m, F.col("yhat"))).alias(name) for m, name in models.items()],
    )
    return wide if n is None else wide.orderBy(*keys).limit(n)
