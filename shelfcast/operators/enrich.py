"""Joining demand with dimensions, markdowns and discounts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.functions.cleaning import fill_numeric
from shelfcast.operators.aggregates import daily_demand, daily_discounts, daily_markdowns
from shelfcast.operators.joins import left_join_dimensions
from shelfcast.schemas import KEYS

MARKDOWN_COLUMNS = ["markdown_quantity", "markdown_price", "markdown_normal_price"]
DISCOUNT_COLUMNS = ["promo_price", "discount_price_before_promo"]


def enrich_dimensions(demand: DataFrame, catalog: DataFrame, stores: DataFrame) -> DataFrame:
    return left_join_dimensions(demand, catalog, stores)


def enrich_markdowns(
    demand: DataFrame, markdowns: DataFrame, keys: list[str] = KEYS
) -> DataFrame:
    """Add the day's markdown figures, 0 where there is none. Both sides have one row per
    key, so no key is heavier than another. Where both hold the same single date, the keys
    can be those of the series."""
    joined = demand.join(daily_markdowns(markdowns, keys), keys, "left")
    return fill_numeric(joined, MARKDOWN_COLUMNS)


def enrich_discounts(
    demand: DataFrame, discounts: DataFrame, keys: list[str] = KEYS
) -> DataFrame:
    """Add the day's promotion figures. Prices are 0 where there is none; the code stays
    null, for the promotion flag tells by it."""
    joined = demand.join(daily_discounts(discounts, keys), keys, "left")
    return fill_numeric(joined, DISCOUNT_COLUMNS)


def demand_panel(sales: DataFrame, markdowns: DataFrame, discounts: DataFrame) -> DataFrame:
    """Daily demand with its markdown and promotion figures.

    Each table is grouped before it is joined. The groupings shuffle on the join keys, so the
    joins add no shuffle of their own, and every side has one row per key, so a key that is
    hot in the raw rows is an ordinary one here.
    """
    return enrich_discounts(enrich_markdowns(daily_demand(sales), markdowns), discounts)
