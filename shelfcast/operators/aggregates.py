"""Aggregation of raw rows to one row per (date, item, store).

All aggregates here are sums, means, maxima and counts, which Spark combines on the map side
before the shuffle: a key that holds a third of the raw rows reaches the reducers as one row
per map task. Rows of a single date may be grouped by the series alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.cleaning import fill_numeric
from shelfcast.schemas import KEYS


def daily_demand(sales: DataFrame) -> DataFrame:
    """Units sold and mean base price; a missing quantity or price counts as 0."""
    return (
        fill_numeric(sales, ["quantity", "price_base"])
        .groupBy(*KEYS)
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.avg("price_base").alias("avg_base_price"),
        )
    )


def daily_markdowns(markdowns: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Units and mean prices of goods sold at markdown; missing numbers count as 0."""
    return (
        fill_numeric(markdowns, ["quantity", "price", "normal_price"])
        .groupBy(*keys)
        .agg(
            F.sum("quantity").alias("markdown_quantity"),
            F.avg("price").alias("markdown_price"),
            F.avg("normal_price").alias("markdown_normal_price"),
        )
    )


def daily_discounts(discounts: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Highest promotion code and mean prices of a promotion; missing prices do not count."""
    return discounts.groupBy(*keys).agg(
        F.max("promo_type_code").alias("promo_type_code"),
        F.avg("sale_price_time_promo").alias("promo_price"),
        F.avg("sale_price_before_promo").alias("discount_price_before_promo"),
    )


def daily_prices(prices: DataFrame) -> DataFrame:
    """Mean planned price; a missing price does not count."""
    return prices.groupBy(*KEYS).agg(F.avg("price").alias("avg_base_price"))


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root mean squared error as a one-row frame."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))
