"""Window columns over a series: one (item, store), ordered by date.

Every window here runs after the daily aggregation, so a series holds at most one row per
calendar date. However hot an item is in the raw sales, its window partition cannot grow
past the number of dates read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.schemas import LAGS, MEANS, SERIES, TARGET


def _ordered():
    return Window.partitionBy(*SERIES).orderBy("date")


def lag_columns(value: str = TARGET, lags: Iterable[int] = LAGS) -> dict[str, Column]:
    """The value ``n`` rows earlier in the series. Rows are counted, not days: a series has
    no row for a date without sales."""
    w = _ordered()
    return {f"lag_{n}_quantity": F.lag(value, n).over(w) for n in lags}


def rolling_mean_columns(value: str = TARGET, widths: Iterable[int] = MEANS) -> dict[str, Column]:
    """Mean of the current row and the ``n - 1`` before it; nulls do not count."""
    w = _ordered()
    return {
        f"rolling_mean_{n}_quantity": F.avg(value).over(w.rowsBetween(1 - n, Window.currentRow))
        for n in widths
    }


def series_columns(value: str = TARGET) -> dict[str, Column]:
    return {**lag_columns(value), **rolling_mean_columns(value)}


NEWEST_FIRST = "newest_first"


def newest_first(past: DataFrame, value: str = TARGET) -> DataFrame:
    """One row per series with its values as a list, latest date first. The list is no longer
    than the dates read."""
    listed = F.sort_array(F.collect_list(F.struct("date", value)), asc=False)
    return past.groupBy(*SERIES).agg(listed[value].alias(NEWEST_FIRST))


def continued_columns(newest: Column, ahead: Column) -> dict[str, Column]:
    """The series columns of a row that follows the listed values by ``ahead`` rows (0 for
    the next), itself and those between without a value."""
    columns = {f"lag_{n}_quantity": F.get(newest, F.lit(n - 1) - ahead) for n in LAGS}
    for n in MEANS:
        reached = F.slice(newest, F.lit(1), F.greatest(F.lit(n - 1) - ahead, F.lit(0)))
        seen = F.filter(reached, lambda v: v.isNotNull())
        total = F.aggregate(seen, F.lit(0.0), lambda a, v: a + v)
        columns[f"rolling_mean_{n}_quantity"] = F.when(F.size(seen) > 0, total / F.size(seen))
    return columns


def closing_columns(current: Column, newest: Column) -> dict[str, Column]:
    """The series columns of a row that follows the listed values and has one of its own."""
    values = F.concat(F.array(current), F.coalesce(newest, F.array().cast("array<double>")))
    columns = {f"lag_{n}_quantity": F.get(values, F.lit(n)) for n in LAGS}
    for n in MEANS:
        seen = F.filter(F.slice(values, 1, n), lambda v: v.isNotNull())
        total = F.aggregate(seen, F.lit(0.0), lambda a, v: a + v)
        columns[f"rolling_mean_{n}_quantity"] = F.when(F.size(seen) > 0, total / F.size(seen))
    return columns
