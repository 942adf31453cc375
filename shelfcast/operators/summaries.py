"""The assortment profile kept up by day: one mergeable, exact summary for each landed date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from shelfcast.operators.profile import TOP_ITEMS, rows_of_items

SUMMARY = StructType(
    [
        StructField("date", DateType()),
        StructField("item_id", StringType()),
        StructField("store_bucket", LongType()),
        StructField("stores", LongType()),
        StructField("n_rows", LongType()),
        StructField("units", DoubleType()),
        StructField("n_units", LongType()),
    ]
)


def day_summaries(sales: DataFrame) -> DataFrame:
    """For each date and item the stores that sold it as bits of a number, one number for each
    64 neighbouring store numbers, with the rows and units of those stores. A number takes a few
    bytes where an item is sold in few stores, and is united as sums are added."""
    bit = F.expr("shiftleft(1L, pmod(store_id, 64))")
    return sales.groupBy(
        "date", "item_id", F.floor(F.col("store_id") / 64).alias("store_bucket")
    ).agg(
        F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias("stores"),
        F.count("*").alias("n_rows"),
        F.sum("quantity").alias("units"),
        F.count("quantity").alias("n_units"),
    )


def profile_of_summaries(summaries: DataFrame, top: int = TOP_ITEMS) -> DataFrame:
    """What ``assortment_profile`` gives for the sales, from their summaries: bits are united,
    sums added, so the result is exact, also when a date was summarised again. Items are ranked
    by the stores and rows of all dates; dates and units are read for those that are shown."""
    united = F.bit_or("stores").alias("stores")
    n_stores = F.sum(F.bit_count("stores")).alias("n_stores")
    every = summaries.groupBy("store_bucket").agg(united).select(n_stores).scalar()
    items = summaries.where("item_id IS NOT NULL").groupBy("item_id", "store_bucket")
    ranked = (
        items.agg(united, F.sum("n_rows").alias("n_rows"))
        .groupBy("item_id")
        .agg(n_stores, F.sum("n_rows").alias("item_rows"))
        .where(F.col("n_stores") == every)
        .orderBy(F.desc("item_rows"), "item_id")
        .limit(top)
    )
    figures = rows_of_items(summaries, ranked).groupBy("item_id", "n_stores", "item_rows").agg(
        F.countDistinct("date").alias("active_days"),
        (F.sum("units") / F.nullif(F.sum("n_units"), F.lit(0))).alias("mean_quantity"),
    )
    ordered = figures.orderBy(F.desc("item_rows"), "item_id")
    return ordered.select(
        "item_id", "n_stores", "active_days", F.col("item_rows").alias("n_rows"), "mean_quantity"
    )
