"""Validation at several cut-offs: error by fold and by day after the cut."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import as_date, date_lit, shift
from shelfcast.functions.cleaning import drop_missing_target
from shelfcast.plans.training import demand_pipeline, model_columns
from shelfcast.schemas import HOLDOUT_DAYS, KEYS, TARGET


def rolling_ends(last: str | dt.date, folds: int, step: int = HOLDOUT_DAYS) -> list[dt.date]:
    """Training ends of some folds, the last one first given, each ``step`` days before the next."""
    return [shift(last, -step * (folds - 1 - n)) for n in range(folds)]


def tag_folds(
    features: DataFrame, ends: Sequence[str | dt.date], holdout_days: int = HOLDOUT_DAYS
) -> DataFrame:
    """Each row once for every fold it takes part in: ``fold`` from 0, ``ahead``, the days after
    the fold's cut, which is 0 or less for what the fold is trained on. A row after a fold's end
    takes no part in it. One pass over the features, no join."""
    ahead = [F.date_diff("date", date_lit(shift(end, -holdout_days))) for end in ends]
    tags = F.array(
        *[
            F.when(a <= holdout_days, F.struct(F.lit(n).alias("fold"), a.alias("ahead")))
            for n, a in enumerate(ahead)
        ]
    )
    tagged = features.withColumn("_tag", F.explode(F.array_compact(tags)))
    return tagged.select("*", "_tag.*").drop("_tag")


def fold_errors(predictions: DataFrame) -> DataFrame:
    """Rows, root mean squared error and mean error of (fold, ahead, target, prediction), by fold
    and day, and over all days of a fold (``ahead`` null)."""
    error = F.col("prediction") - F.col(TARGET)
    figures = (
        F.count("*").alias("n_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("mean_error"),
    )
    by_day = predictions.groupBy("fold", "ahead").agg(*figures)
    whole = predictions.groupBy("fold").agg(*figures).withColumn("ahead", F.lit(None).cast("int"))
    return by_day.unionByName(whole)


def backtest(
    features: DataFrame,
    ends: Sequence[str | dt.date],
    holdout_days: int = HOLDOUT_DAYS,
    pipeline: Pipeline | None = None,
) -> DataFrame:
    """Errors of models fitted up to each of several cuts, ``holdout_days`` before each end, on
    the days between. Folds without rows to train on or to validate are left out; with none left
    the result is empty. Give it features read from a zone: each fold reads its part of them."""
    tagged = tag_folds(drop_missing_target(features), [as_date(e) for e in ends], holdout_days)
    scored = []
    for n in range(len(ends)):
        fold = tagged.where(F.col("fold") == n)
        training, held_out = fold.where("ahead <= 0"), fold.where("ahead > 0")
        if training.isEmpty() or held_out.isEmpty():
            continue
        model = (pipeline or demand_pipeline()).fit(training.select(*model_columns()))
        scored.append(model.transform(held_out).select("fold", "ahead", *KEYS, TARGET, "prediction"))
    if not scored:
        none = tagged.where(F.lit(False)).withColumn("prediction", F.lit(None).cast("double"))
        return fold_errors(none)
    predictions = scored[0]
    for one in scored[1:]:
        predictions = predictions.unionByName(one)
    return fold_errors(predictions)
