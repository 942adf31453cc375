"""Bringing corrected past days into a feature zone without building it anew."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.series import series_columns
from shelfcast.operators.aggregates import daily_demand
from shelfcast.operators.enrich import enrich_discounts, enrich_markdowns
from shelfcast.plans.features import finish_features
from shelfcast.schemas import (
    FEATURE_COLUMNS,
    KEYS,
    LAGS,
    MEANS,
    SERIES,
    SERIES_COLUMNS,
    TARGET,
)
from shelfcast.sources.zones import on_dates

# Rows after a changed one that can still see it: the longest lag.
REACH = max(*LAGS, *(n - 1 for n in MEANS))


def change_set(history: DataFrame, demand: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """The rows of some dates as a feature zone has them beside as the sales now give them: keys,
    the new total, ``was`` and ``is_now`` (1 where that side has the row) and ``changed``."""
    was = on_dates(history.select(*KEYS, TARGET), dates).withColumnRenamed(TARGET, "_was")
    both = was.withColumn("was", F.lit(1)).join(
        demand.select(*KEYS, TARGET).withColumn("is_now", F.lit(1)), KEYS, "full"
    )
    same = F.col("was").eqNullSafe(F.col("is_now")) & F.col("_was").eqNullSafe(F.col(TARGET))
    return both.select(
        *KEYS,
        TARGET,
        F.coalesce("was", F.lit(0)).alias("was"),
        F.coalesce("is_now", F.lit(0)).alias("is_now"),
        (~same).alias("changed"),
    )


def reached_rows(history: DataFrame, changes: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Keys and new series columns of every row that a change reaches: the changed row, and as
    many rows after it in its series as the longest lag looks back, counted as they were or as
    they are. Only series with a change are read into the windows; one sort serves them all."""
    moved = changes.where("changed").select(*SERIES).distinct()
    others = on_dates(history.select(*KEYS, TARGET), dates, keep=False)
    others = others.withColumns({"was": F.lit(1), "is_now": F.lit(1), "changed": F.lit(False)})
    line = others.unionByName(changes).join(moved, SERIES, "left_semi")
    w = Window.partitionBy(*SERIES).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    counted = line.withColumns({f"_n_{c}": F.sum(c).over(w) for c in ("was", "is_now")})
    since = {
        f"_since_{c}": F.col(f"_n_{c}")
        - F.last(F.when(F.col("changed"), F.col(f"_n_{c}")), ignorenulls=True).over(w)
        for c in ("was", "is_now")
    }
    near = F.coalesce(F.least("_since_was", "_since_is_now") <= REACH, F.lit(False))
    rows = counted.withColumns(since).where("is_now = 1").withColumn("_near", near)
    return rows.withColumns(series_columns()).where("_near").select(*KEYS, *SERIES_COLUMNS)


def corrected_features(
    history: DataFrame,
    sales: DataFrame,
    catalog: DataFrame,
    stores: DataFrame,
    markdowns: DataFrame,
    discounts: DataFrame,
    dates: Sequence[dt.date],
    store_rows: Callable[[DataFrame, str], DataFrame],
) -> tuple[DataFrame, list[dt.date]]:
    """All rows of the dates that corrected sales of ``dates`` touch, and those dates, so that
    they can replace them in the feature zone ``history``. Together with the dates left alone
    they are what a full build gives.

    The corrected dates are grouped from the sales again, with their markdowns and discounts. On
    the dates after them the rows that a change reaches get new lags and means, all others stay
    as they are. ``store_rows`` writes a frame under a name and reads it back: the reached rows are worked out
    once, and their dates tell which folders of the zone are opened. A date the zone lacks is
    added; a row that the sales no longer have goes. Dates are one entry each for the driver.
    """
    demand = daily_demand(on_dates(sales, dates))
    changes = store_rows(change_set(history, demand, dates), "changes")
    reached = reached_rows(history, changes, dates).na.fill(0.0, SERIES_COLUMNS)
    reached = store_rows(reached, "reached")
    later = {r["date"] for r in reached.select("date").distinct().collect()} - set(dates)
    new = reached.select(*KEYS, *[F.col(c).alias(f"_new_{c}") for c in SERIES_COLUMNS])
    renewed = {c: F.coalesce(f"_new_{c}", c) for c in SERIES_COLUMNS}

    stay = on_dates(history.select(*FEATURE_COLUMNS), later).join(new, KEYS, "left")
    stay = stay.withColumns(renewed).select(*FEATURE_COLUMNS)

    known = on_dates(history.select(*KEYS, *SERIES_COLUMNS), dates)
    rows = demand.join(known, KEYS, "left").join(new, KEYS, "left").withColumns(renewed)
    rows = enrich_markdowns(rows, on_dates(markdowns, dates))
    rows = enrich_discounts(rows, on_dates(discounts, dates))
    return stay.unionByName(finish_features(rows, catalog, stores)), sorted({*later, *dates})
