"""Category labels as a table, for columns with more values than a driver should hold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.cleaning import drop_missing_target
from shelfcast.operators.places import with_place
from shelfcast.operators.split import train_validation_split
from shelfcast.plans.training import SEED, TREES, feature_assembler
from shelfcast.schemas import CATEGORY_INPUTS, HOLDOUT_DAYS, NUMERIC_INPUTS, TARGET


def label_table(
    df: DataFrame, columns: list[str], store_rows: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """(column_name, value, position): the values of each column numbered from 0 by falling
    frequency, ties by value, as ``category_indexer`` numbers them; missing values have none. One
    pass counts all columns, with map-side combine; the order is drawn over all values at once,
    so no task and no driver holds a column's. What is collected is one number a column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    seen = df.select(F.explode(pairs).alias("pair")).select("pair.*").where("value IS NOT NULL")
    counts = store_rows(seen.groupBy("column_name", "value").agg(F.count("*").alias("n_rows")), "counts")
    order = [F.col("column_name").asc(), F.col("n_rows").desc(), F.col("value").asc()]
    placed = with_place(counts, order, store_rows)
    firsts = placed.groupBy("column_name").agg(F.min("place")).collect()
    first = F.lit(0)
    for name, place in firsts:
        first = F.when(F.col("column_name") == name, F.lit(place)).otherwise(first)
    return placed.select("column_name", "value", (F.col("place") - first).cast("double").alias("position"))


def index_by_table(df: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<column>_indexed`` by a join with the labels for each column; a value the labels do
    not have, or none, gets the number after the last. Few labels are broadcast, many are
    shuffled by value, with a hot value on the left of the left join."""
    sizes = dict(map(tuple, labels.groupBy("column_name").count().collect()))
    for c in columns:
        side = labels.where(F.col("column_name") == c)
        side = side.select(F.col("value").alias("_value"), F.col("position").alias(f"{c}_indexed"))
        df = df.join(side, F.col(c).cast("string") == F.col("_value"), "left").drop("_value")
        df = df.na.fill(float(sizes.get(c, 0)), [f"{c}_indexed"])
    return df


def indexed_pipeline(
    columns: list[str] = CATEGORY_INPUTS,
    numeric: list[str] = NUMERIC_INPUTS,
    trees: int = TREES,
    seed: int = SEED,
    **forest: object,
) -> Pipeline:
    """Encoding and forest over columns indexed already. The encoder learns the number of values
    of each column and nothing else; one slot a value, none for the unseen."""
    encoder = OneHotEncoder(
        inputCols=[f"{c}_indexed" for c in columns],
        outputCols=[f"{c}_encoded" for c in columns],
        handleInvalid="keep",
    )
    regressor = RandomForestRegressor(
        featuresCol="features", labelCol=TARGET, numTrees=trees, seed=seed, **forest
    )
    return Pipeline(stages=[encoder, feature_assembler(numeric, columns), regressor])


def train_with_labels(
    features: DataFrame,
    training_end: str | dt.date,
    store_rows: Callable[[DataFrame, str], DataFrame],
    holdout_days: int = HOLDOUT_DAYS,
    columns: list[str] = CATEGORY_INPUTS,
    pipeline: Pipeline | None = None,
) -> tuple[PipelineModel, DataFrame] | None:
    """A model and the label table that its rows are to be indexed by; None without rows."""
    training, _ = train_validation_split(drop_missing_target(features), training_end, holdout_days)
    if training.isEmpty():
        return None
    labels = store_rows(label_table(training, columns, store_rows), "labels")
    wanted = list(dict.fromkeys([TARGET, *NUMERIC_INPUTS, *[f"{c}_indexed" for c in columns]]))
    rows = store_rows(index_by_table(training, labels, columns).select(*wanted), "indexed")
    return (pipeline or indexed_pipeline(columns)).fit(rows), labels
