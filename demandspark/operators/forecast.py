"""Chronological split, baselines, learned models and batch scoring."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    TargetEncoder,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.functions import rules as R
from demandspark.operators.boosting import BoostedTrees
from demandspark.operators.features import serving_features
from demandspark.operators.forest import Forest
from demandspark.operators.lookup import admit
from demandspark.operators.side_by_side import side_by_side

LEARNED = [schemas.LINEAR, schemas.FOREST, schemas.BOOSTED]


def split_date(df: DataFrame, ratio: float = 0.20) -> DataFrame:
    """One row: the number of distinct days and the day at which the test set starts.

    The set of distinct days is built from partial sets, and has one entry per calendar day.
    """
    days = df.agg(F.sort_array(F.collect_set("Date")).alias("days"))
    index = F.floor(F.size("days") * F.lit(1.0 - ratio)).cast("int")
    return days.select(F.size("days").alias("distinct_dates"), F.get("days", index).alias("split_date"))


def chronological_split(
    df: DataFrame, ratio: float = 0.20, calendar: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, split): all days before the split date, all days from it on, and the
    one-row result of split_date. The date is a scalar subquery, found when a part is used;
    ``calendar`` names a cheaper table with the same days, such as the panel below a feature table.
    """
    split = split_date(df if calendar is None else calendar, ratio)
    start = split.select("split_date").scalar()
    return df.filter(F.col("Date") < start), df.filter(F.col("Date") >= start), split


def split_summary(df: DataFrame, ratio: float = 0.20) -> DataFrame:
    """Rows and day range of both parts, from the counts per day."""
    days = df.groupBy("Date").agg(F.count("*").alias("n"))
    start = split_date(days, ratio).select("split_date").scalar()
    part = F.when(F.col("Date") < start, "train").otherwise("test")
    return days.groupBy(part.alias("part")).agg(
        F.sum("n").alias("row_count"), F.min("Date").alias("first_date"), F.max("Date").alias("last_date")
    )


def naive_value(columns: Iterable[str]) -> Column:
    if "Lag_1" in columns:
        return C.at_least_zero(F.col("Lag_1"))
    return F.lit(0.0)


def moving_average_value(columns: Iterable[str]) -> Column:
    if "Rolling_Mean_7" in columns:
        return C.at_least_zero(F.col("Rolling_Mean_7"))
    return naive_value(columns)


def naive_forecast(df: DataFrame) -> DataFrame:
    """The previous row's units, not below zero; zeros if the table has no lag."""
    return df.withColumn("yhat", naive_value(df.columns))


def moving_average_forecast(df: DataFrame) -> DataFrame:
    """The mean of the previous seven rows, else the previous row, else zero."""
    return df.withColumn("yhat", moving_average_value(df.columns))


def to_long(df: DataFrame, predictions: Mapping[str, Column]) -> DataFrame:
    """One row per panel row and model: keys, model, y, yhat. The table is read once for all."""
    rows = [F.struct(F.lit(name).alias("model"), value.alias("yhat")) for name, value in predictions.items()]
    return df.select(*schemas.PANEL_KEYS, F.col(schemas.TARGET).alias("y"), F.inline(F.array(*rows)))


def baseline_predictions(df: DataFrame) -> DataFrame:
    return to_long(
        df,
        {
            schemas.NAIVE: naive_value(df.columns),
            schemas.MOVING_AVERAGE: moving_average_value(df.columns),
        },
    )


def preprocessor_stages() -> list:
    """One-hot categories (an unknown value gives all zeros) and scaled numbers in one vector."""
    categories, numbers = schemas.CATEGORICAL_FEATURES, schemas.NUMERICAL_FEATURES
    indexed = [f"{c}_index" for c in categories]
    encoded = [f"{c}_hot" for c in categories]
    return [
        StringIndexer(
            inputCols=categories, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        # "keep" gives unknown values the last index, and the encoder drops just that.
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=numbers, outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=[*encoded, "scaled"], outputCol="features"),
    ]


def tree_stages() -> list:
    """Each category as the mean target of its training rows, and plain numbers, in one vector.

    As wide as the list of features, however many products there are; an unknown value gets the
    mean of all rows.
    """
    categories, numbers = schemas.CATEGORICAL_FEATURES, schemas.NUMERICAL_FEATURES
    indexed = [f"{c}_index" for c in categories]
    means, levels = [f"{c}_mean" for c in categories], [f"{c}_level" for c in categories]
    # The encoder marks its output as categories like its input; a sum is a plain number again.
    plain = ", ".join(f"0D + {mean} AS {level}" for mean, level in zip(means, levels, strict=True))
    return [
        StringIndexer(
            inputCols=categories, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        TargetEncoder(
            inputCols=indexed, outputCols=means, labelCol=schemas.TARGET, targetType="continuous", handleInvalid="keep"
        ),
        SQLTransformer(statement=f"SELECT *, {plain} FROM __THIS__"),
        VectorAssembler(inputCols=[*levels, *numbers], outputCol="features"),
    ]


def stages_for(kind: str) -> list:
    return preprocessor_stages() if kind == schemas.LINEAR else tree_stages()


def regressor(kind: str, **params):
    """The regressor of a learned model; ``params`` override the reference settings."""
    common = {"featuresCol": "features", "labelCol": schemas.TARGET, "predictionCol": "raw_prediction"}
    if kind == schemas.LINEAR:
        return LinearRegression(**{**common, "regParam": 0.0, **params})
    if kind == schemas.FOREST:
        settings = {"numTrees": 100, "maxDepth": 12, "maxBins": 64, "seed": 42}
        return Forest(**{**common, **settings, **params})
    if kind == schemas.BOOSTED:
        settings = {
            "maxIter": 150, "stepSize": 0.08, "maxDepth": 6, "subsamplingRate": 0.85,
            "columnRate": 0.85, "regLambda": 1.0, "maxBins": 64, "seed": 42,
        }
        return BoostedTrees(**{**common, **settings, **params})
    raise ValueError(f"unknown model: {kind}")


def learned_pipeline(kind: str, **params) -> Pipeline:
    return Pipeline(stages=[*stages_for(kind), regressor(kind, **params)])


def fit_models(
    train: DataFrame,
    kinds: Iterable[str] = LEARNED,
    params: Mapping[str, dict] | None = None,
    leave_out: bool = True,
) -> dict[str, PipelineModel]:
    """Fit the learned models side by side; encoding and scaling are fitted on the training rows only, once for the
    linear model and once for the trees.

    A model that cannot be fitted does not stop the others. With ``leave_out`` it is left out with a warning, and an
    error is raised if none can be fitted; without, an error is raised if any cannot.
    """
    params = params or {}
    kinds = list(kinds)
    families = [[k for k in kinds if k == schemas.LINEAR], [k for k in kinds if k != schemas.LINEAR]]
    vectors, fits = [], {}
    try:
        for family in filter(None, families):
            prepared = Pipeline(stages=stages_for(family[0])).fit(train)
            # Trees pass over the data once per level; keep the vectors, spilling to disk.
            kept = prepared.transform(train).select("features", F.col(schemas.TARGET).cast("double")).persist()
            vectors.append(kept)
            for kind in family:
                fits[kind] = partial(_fitted, kind, params.get(kind, {}), prepared, kept)
        models, failures = side_by_side(train.sparkSession, fits)
    finally:
        for kept in vectors:
            kept.unpersist()
    if failures and not models:
        raise ExceptionGroup("no model could be fitted", list(failures.values()))
    if failures and not leave_out:
        raise ExceptionGroup(f"could not be fitted: {', '.join(failures)}", list(failures.values()))
    for kind, error in failures.items():
        warnings.warn(f"{kind} could not be fitted: {error}", stacklevel=2)
    return {kind: models[kind] for kind in kinds if kind in models}


def _fitted(kind: str, params: dict, prepared: PipelineModel, vectors: DataFrame) -> PipelineModel:
    return PipelineModel([*prepared.stages, regressor(kind, **params).fit(vectors)])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds the model's demand, not below zero, as ``yhat``."""
    scored = model.transform(df)
    return scored.select(*df.columns, C.at_least_zero(F.col("raw_prediction")).alias("yhat"))


def model_predictions(models: Mapping[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Long predictions of all models over ``df``, which is read once."""
    wide = df
    for i, model in enumerate(models.values()):
        wide = predict(model, wide).withColumnRenamed("yhat", f"yhat_{i}")
    return to_long(wide, {name: F.col(f"yhat_{i}") for i, name in enumerate(models)})


def train_all(
    train: DataFrame,
    test: DataFrame,
    kinds: Iterable[str] = LEARNED,
    params: Mapping[str, dict] | None = None,
    leave_out: bool = False,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit the learned models and predict the test rows with them and both baselines. An error is raised if a model
    cannot be fitted, unless it may be left out."""
    models = fit_models(train, kinds, params, leave_out)
    predictions = baseline_predictions(test).unionByName(model_predictions(models, test))
    return models, predictions


def score_requests(
    model: PipelineModel | None,
    requests: DataFrame,
    history: DataFrame,
    catalog: DataFrame,
    regions: DataFrame,
    model_name: str,
    as_of: str | None = None,
    few_requests: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Score a table of requests. Returns (forecasts, rejects).

    Requests that break a rule or name an unknown product are rejects. Without a model the
    moving average scores.
    """
    accepted, rejects = admit(requests, R.SCORE_RULES, catalog)
    inputs = serving_features(accepted, history, None, regions, as_of, few_requests)
    scored = moving_average_forecast(inputs) if model is None else predict(model, inputs)
    extra = [c for c in requests.columns if c not in R.SCORE_RULES]
    forecasts = scored.select(
        *extra,
        F.col("Product_ID").alias("product_id"),
        F.col("Store_ID").alias("store_id"),
        "forecast_date",
        C.demand_units(F.col("yhat")).alias("predicted_demand"),
        F.lit(model_name).alias("model_name"),
    )
    return forecasts, rejects


def requests_for_missing(missing: DataFrame, store: str, day: str) -> DataFrame:
    """A request per product without forecasts, for one store and day."""
    return missing.select(
        "product_id",
        F.lit(store).alias("store_id"),
        F.lit(day).cast("date").alias("forecast_date"),
        F.lit(None).cast("double").alias("unit_price"),
        F.lit(0.0).alias("discount"),
        F.lit(0).alias("promotion"),
        F.lit(0).alias("holiday"),
        F.lit(None).cast("double").alias("lag_1"),
        F.lit(None).cast("double").alias("rolling_mean_7"),
    )
