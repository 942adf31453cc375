"""The feature table: full history, one day, and the rows to be forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import as_date, calendar_columns, date_lit, shift
from shelfcast.functions.cleaning import fill_categories, fill_numeric
from shelfcast.functions.scalars import promotion_flag
from shelfcast.functions.series import (
    NEWEST_FIRST,
    closing_columns,
    newest_first,
    series_columns,
)
from shelfcast.operators.aggregates import daily_demand
from shelfcast.operators.enrich import (
    demand_panel,
    enrich_dimensions,
    enrich_discounts,
    enrich_markdowns,
)
from shelfcast.schemas import (
    ATTRIBUTES,
    FEATURE_COLUMNS,
    LOOKBACK_DAYS,
    PRICE_COLUMNS,
    SERIES,
    SERIES_COLUMNS,
    TARGET,
)
from shelfcast.sources.zones import between_dates


def described_rows(rows: DataFrame, catalog: DataFrame, stores: DataFrame) -> DataFrame:
    """The rows with their calendar and the attributes of item and store."""
    return enrich_dimensions(rows.withColumns(calendar_columns()), catalog, stores)


def finish_described(rows: DataFrame) -> DataFrame:
    """Described rows with the promotion flag, null fills and the final column order."""
    flagged = rows.withColumn("on_promotion", promotion_flag())
    filled = fill_numeric(flagged, PRICE_COLUMNS + SERIES_COLUMNS)
    return fill_categories(filled, ATTRIBUTES).select(*FEATURE_COLUMNS)


def finish_features(rows: DataFrame, catalog: DataFrame, stores: DataFrame) -> DataFrame:
    """Everything that looks at one row only, shared by history and forecast rows: promotion
    flag, calendar, item and store attributes, null fills and the final column order."""
    return finish_described(described_rows(rows, catalog, stores))


def feature_table(
    sales: DataFrame,
    catalog: DataFrame,
    stores: DataFrame,
    markdowns: DataFrame,
    discounts: DataFrame,
) -> DataFrame:
    """One row of 31 features per (date, item, store) with sales.

    Shuffles: one per grouped table, which their joins share, and one to bring each series
    together for its windows. The attribute text joins afterwards, so it travels in none.
    """
    panel = demand_panel(sales, markdowns, discounts)
    return finish_features(panel.withColumns(series_columns()), catalog, stores)


def feature_table_for_day(
    sales: DataFrame,
    catalog: DataFrame,
    stores: DataFrame,
    markdowns: DataFrame,
    discounts: DataFrame,
    process_date: str | dt.date,
    lookback_days: int = LOOKBACK_DAYS,
    history: DataFrame | None = None,
) -> DataFrame:
    """The features of one date, from that date and the ``lookback_days`` before it.

    The windows need past quantities only, so markdowns and discounts are read for the one
    date and joined once the other dates are gone. With one date on both sides the series is
    key enough, and the rows already lie together by it for the windows.

    ``history``, a feature zone, gives the past by the daily totals it holds: then the sales
    are read for the one date, and each series brings its past as one list. It has to hold all
    dates of the look-back that have sales; without it they are grouped again.
    """
    day = as_date(process_date)
    first = shift(day, -lookback_days)
    if history is None:
        window = between_dates(sales, first, day)
        rows = daily_demand(window).withColumns(series_columns())
        rows = rows.where(F.col("date") == date_lit(day))
    else:
        past = newest_first(between_dates(history, first, shift(day, -1)))
        rows = daily_demand(between_dates(sales, day, day)).join(past, SERIES, "left")
        rows = rows.withColumns(closing_columns(F.col(TARGET), F.col(NEWEST_FIRST)))
        rows = rows.drop(NEWEST_FIRST)
    rows = enrich_markdowns(rows, between_dates(markdowns, day, day), SERIES)
    rows = enrich_discounts(rows, between_dates(discounts, day, day), SERIES)
    return finish_features(rows, catalog, stores)
