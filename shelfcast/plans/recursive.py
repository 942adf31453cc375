"""Forecasts fed back: each day of the horizon sees what was forecast for the days before it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import date_lit, shift
from shelfcast.functions.scalars import whole_units
from shelfcast.functions.series import NEWEST_FIRST, newest_first
from shelfcast.operators.joins import item_store_grid
from shelfcast.plans.features import finish_features
from shelfcast.plans.frame import date_spine, planned_tables, with_plan_by_series
from shelfcast.schemas import (
    FEATURE_COLUMNS,
    HORIZON_DAYS,
    KEYS,
    LAGS,
    LOOKBACK_DAYS,
    MEANS,
    SERIES,
    TARGET,
)
from shelfcast.sources.zones import between_dates

AHEAD = "_ahead"
_GIVEN = "_given"


def _known_columns(newest: Column, ahead: Column) -> dict[str, Column]:
    """What the past alone gives the row ``ahead`` days into the horizon: its lags as far as they
    reach the past, and for each mean the sum and count of the values in it that are past."""
    columns = {f"lag_{n}_quantity": F.get(newest, F.lit(n - 1) - ahead) for n in LAGS}
    for n in MEANS:
        past = F.slice(newest, F.lit(1), F.greatest(F.lit(n - 1) - ahead, F.lit(0)))
        seen = F.filter(past, lambda v: v.isNotNull())
        columns[f"_sum_{n}"] = F.aggregate(seen, F.lit(0.0), lambda a, v: a + v)
        columns[f"_seen_{n}"] = F.greatest(F.size(seen), F.lit(0))
    return columns


def _with_given(rows: DataFrame, ahead: int) -> DataFrame:
    """Lags and means of the rows of one day, ``_given`` being the series' forecasts of the days
    before it, by day."""
    given = F.coalesce(F.col(_GIVEN), F.create_map().cast("map<int,double>"))
    columns = {}
    for n in LAGS:
        if ahead >= n:
            columns[f"lag_{n}_quantity"] = F.try_element_at(given, F.lit(ahead - n))
    for n in MEANS:
        seen = F.array_compact(
            F.array(*[F.try_element_at(given, F.lit(h)) for h in range(max(ahead - n + 1, 0), ahead)])
        ).cast("array<double>")
        total = F.coalesce(f"_sum_{n}", F.lit(0.0)) + F.aggregate(seen, F.lit(0.0), lambda a, v: a + v)
        count = F.coalesce(f"_seen_{n}", F.lit(0)) + F.size(seen)
        columns[f"rolling_mean_{n}_quantity"] = F.when(count > 0, total / count)
    return rows.withColumns(columns)


def recursive_forecast(
    model: PipelineModel,
    history: DataFrame,
    catalog: DataFrame,
    stores: DataFrame,
    markdowns: DataFrame,
    discounts: DataFrame,
    prices: DataFrame,
    start: str | dt.date,
    store_rows: Callable[[DataFrame, str], DataFrame],
    days: int = HORIZON_DAYS,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """The feature columns of every forecast row with ``predicted_quantity``, day by day: the
    whole units forecast for a day stand in front of the series before the next day is scored, so
    lags and means of later days are of values instead of gaps. A row's own quantity is not known
    when it is scored and counts in none of its means, as in ``inference_features``.

    What the past and the plans give each row of the horizon is worked out once and written by
    day. A day then reads its own rows and joins the few forecasts made so far, one short list for
    each series; past values and plans are shuffled once however long the horizon is.
    ``store_rows`` writes a frame under a name and reads it back, which ends a day's lineage: a
    lost executor costs that day at most.
    """
    past = between_dates(history, shift(start, -1 - lookback_days), shift(start, -1))
    planned = planned_tables(markdowns, discounts, prices, start, days)
    series = item_store_grid(catalog, stores).join(newest_first(past), SERIES, "left")
    series, figures = with_plan_by_series(series, planned)
    rows = date_spine(series, start, days).withColumn(AHEAD, F.date_diff("date", date_lit(start)))
    known = _known_columns(F.col(NEWEST_FIRST), F.col(AHEAD))
    inputs = store_rows(
        rows.select(
            *KEYS,
            AHEAD,
            F.lit(None).cast("double").alias(TARGET),
            *[value.alias(name) for name, value in (figures | known).items()],
        ),
        "inputs",
    )
    done: list[DataFrame] = []
    for ahead in range(days):
        today = inputs.where(F.col(AHEAD) == ahead)
        given = F.lit(None).cast("map<int,double>").alias(_GIVEN)
        if done:
            made = [
                df.select(*SERIES, F.lit(h).alias("_day"), F.col("predicted_quantity").cast("double").alias("_units"))
                for h, df in enumerate(done)
                if h >= ahead - max(LAGS)
            ]
            lists = made[0]
            for one in made[1:]:
                lists = lists.unionByName(one)
            entries = F.collect_list(F.struct("_day", "_units"))
            lists = lists.groupBy(*SERIES).agg(F.map_from_entries(entries).alias(_GIVEN))
            today = today.join(lists, SERIES, "left")
        else:
            today = today.withColumn(_GIVEN, given)
        features = finish_features(_with_given(today, ahead), catalog, stores)
        scored = model.transform(features).withColumn(
            "predicted_quantity", whole_units(F.col("prediction"))
        )
        done.append(store_rows(scored.select(*FEATURE_COLUMNS, "predicted_quantity"), f"day-{ahead}"))
    found = done[0]
    for one in done[1:]:
        found = found.unionByName(one)
    return found
