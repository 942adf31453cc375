"""Item selection and splits on a date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import shift
from shelfcast.schemas import HOLDOUT_DAYS, RECENT_DAYS
from shelfcast.sources.zones import between_dates


Items = Iterable[str] | DataFrame | None


def select_items(df: DataFrame, items: Items) -> DataFrame:
    """Rows of some items: all for None. A short list reaches the scan as a pushed filter; a
    long one is given as a frame with ``item_id`` and joined."""
    if items is None:
        return df
    if isinstance(items, DataFrame):
        return df.join(items.select("item_id").distinct(), "item_id", "left_semi")
    return df.where(F.col("item_id").isin(list(items)))


def select_items_static(tables: dict[str, DataFrame], items: Items) -> dict:
    """The side tables cut to the items; stores have no item and stay whole."""
    return {n: df if n == "stores" else select_items(df, items) for n, df in tables.items()}


def split_on(df: DataFrame, cut: Column) -> tuple[DataFrame, DataFrame]:
    """Rows dated before ``cut`` and rows dated on it or after."""
    return df.where(F.col("date") < cut), df.where(F.col("date") >= cut)


def recent_cut(sales: DataFrame, recent_days: int = RECENT_DAYS) -> DataFrame:
    """The first recent date, one row: ``recent_days`` before the last date."""
    return sales.select(F.date_sub(F.max("date"), recent_days).alias("cut"))


def tag_recent(sales: DataFrame, cut: Column | None = None) -> DataFrame:
    """The sales with column ``part``, history or recent, in one pass over them beside the one
    that finds the cut, unless that is given."""
    cut = recent_cut(sales).scalar() if cut is None else cut
    return sales.withColumn("part", F.when(F.col("date") < cut, "history").otherwise("recent"))


def history_split(
    sales: DataFrame, items: Items = None, cut: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """History and recent sales of the chosen items, at ``recent_cut`` unless a cut is given.
    As a default the cut is a scalar subquery: nothing runs until a part is used."""
    kept = select_items(sales, items)
    return split_on(kept, recent_cut(kept).scalar() if cut is None else cut)


def train_validation_split(
    features: DataFrame, training_end: str | dt.date, holdout_days: int = HOLDOUT_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Rows up to ``holdout_days`` before the training end, and the rows after that up to the
    end."""
    last_trained = shift(training_end, -holdout_days)
    return (
        between_dates(features, last=last_trained),
        between_dates(features, shift(last_trained, 1), training_end),
    )
