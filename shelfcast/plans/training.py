"""Encoding, the random forest, validation and scoring."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.cleaning import drop_missing_target
from shelfcast.functions.scalars import whole_units
from shelfcast.operators.split import train_validation_split
from shelfcast.schemas import (
    CATEGORY_INPUTS,
    FORECAST_COLUMNS,
    HOLDOUT_DAYS,
    NUMERIC_INPUTS,
    TARGET,
)

# Forest size and seed.
TREES = 50
SEED = 42


def category_indexer(columns: list[str] = CATEGORY_INPUTS) -> StringIndexer:
    """Numbers categories by falling frequency, ties by name. One pass counts all columns;
    a value not seen in training, or none, gets the index after the last."""
    return StringIndexer(
        inputCols=columns, outputCols=[f"{c}_indexed" for c in columns], handleInvalid="keep"
    )


def category_encoder(columns: list[str] = CATEGORY_INPUTS) -> OneHotEncoder:
    """One slot per category seen in training; the unseen index has no slot of its own."""
    return OneHotEncoder(
        inputCols=[f"{c}_indexed" for c in columns], outputCols=[f"{c}_encoded" for c in columns]
    )


def feature_assembler(
    numeric: list[str] = NUMERIC_INPUTS, columns: list[str] = CATEGORY_INPUTS
) -> VectorAssembler:
    return VectorAssembler(
        inputCols=numeric + [f"{c}_encoded" for c in columns],
        outputCol="features",
        handleInvalid="keep",
    )


def demand_pipeline(
    trees: int = TREES,
    seed: int = SEED,
    columns: list[str] = CATEGORY_INPUTS,
    numeric: list[str] = NUMERIC_INPUTS,
    **forest: object,
) -> Pipeline:
    """Encoding and forest. The labels of each category are held by the driver and the model:
    with very many items give ``columns`` without ``item_id``. ``forest`` holds further
    parameters of the regressor."""
    regressor = RandomForestRegressor(
        featuresCol="features", labelCol=TARGET, numTrees=trees, seed=seed, **forest
    )
    encoding = [category_indexer(columns), category_encoder(columns)]
    return Pipeline(stages=[*encoding, feature_assembler(numeric, columns), regressor])


def train_model(
    features: DataFrame,
    training_end: str | dt.date,
    holdout_days: int = HOLDOUT_DAYS,
    pipeline: Pipeline | None = None,
) -> PipelineModel | None:
    """Fit on the rows before the hold-out; None when there are none.

    Give it features read from a zone: fitting makes several passes, and each would build
    the features again. The forest keeps its own binned copy of the rows between levels.
    """
    training, _ = train_validation_split(drop_missing_target(features), training_end, holdout_days)
    if training.isEmpty():
        return None
    return (pipeline or demand_pipeline()).fit(training.select(*model_columns()))


def model_columns() -> list[str]:
    """What fitting reads of the features."""
    return list(dict.fromkeys([TARGET, *NUMERIC_INPUTS, *CATEGORY_INPUTS]))


def validation_predictions(
    model: PipelineModel,
    features: DataFrame,
    training_end: str | dt.date,
    holdout_days: int = HOLDOUT_DAYS,
) -> DataFrame:
    _, held_out = train_validation_split(drop_missing_target(features), training_end, holdout_days)
    return model.transform(held_out)


def validation_rmse(predictions: DataFrame) -> float | None:
    """Root mean squared error on the held-out rows; None when there are none."""
    if predictions.isEmpty():
        return None
    return RegressionEvaluator(
        labelCol=TARGET, predictionCol="prediction", metricName="rmse"
    ).evaluate(predictions)


def save_model(model: PipelineModel, path: str) -> None:
    """Store the fitted stages, replacing an older model at the path."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, inference: DataFrame) -> DataFrame:
    """Forecasts in whole, non-negative units."""
    scored = model.transform(inference)
    return scored.withColumn("predicted_quantity", whole_units(F.col("prediction"))).select(
        *FORECAST_COLUMNS
    )

