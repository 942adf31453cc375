"""Assortment profiling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import ITEM_ATTRIBUTES

TOP_ITEMS = 10


def stores_per_item(sales: DataFrame) -> DataFrame:
    return sales.groupBy("item_id").agg(F.countDistinct("store_id").alias("n_stores"))


def active_days_per_item(sales: DataFrame) -> DataFrame:
    return sales.groupBy("item_id").agg(F.countDistinct("date").alias("active_days"))


def rows_per_item(sales: DataFrame) -> DataFrame:
    """Row count per item, largest first."""
    return (
        sales.groupBy("item_id")
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), "item_id")
    )


def mean_quantity_per_item(sales: DataFrame) -> DataFrame:
    """Mean quantity per item over the rows that have one."""
    return sales.groupBy("item_id").agg(F.avg("quantity").alias("mean_quantity"))


def sales_date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def _by_item_and_store(sales: DataFrame) -> DataFrame:
    return sales.groupBy("item_id", "store_id").agg(F.count("*").alias("n_rows"))


def _every_store(groups: DataFrame):
    """Number of stores in ``groups``, one row a store or more, as a scalar subquery. It reads
    the columns the query around it uses, in a test that always holds: then both are the same
    grouping of one scan, and Spark works it out once."""
    real = F.col("n_rows") > 0
    return groups.select(F.count_distinct(F.when(real, F.col("store_id")))).scalar()


def items_in_all_stores(sales: DataFrame) -> DataFrame:
    """Items sold in every store that sells anything."""
    groups = _by_item_and_store(sales)
    sold = F.when(F.col("n_rows") > 0, F.col("store_id"))
    counted = groups.groupBy("item_id").agg(F.count(sold).alias("n_stores"))
    return counted.where(F.col("n_stores") == _every_store(groups))


def _top_counts(sales: DataFrame, top: int) -> DataFrame:
    groups = _by_item_and_store(sales)
    return (
        groups.groupBy("item_id")
        .agg(F.count("store_id").alias("n_stores"), F.sum("n_rows").alias("n_rows"))
        .where(F.col("n_stores") == _every_store(groups))
        .orderBy(F.desc("n_rows"), "item_id")
        .limit(top)
    )


def rows_of_items(df: DataFrame, items: DataFrame) -> DataFrame:
    """Rows whose item is one of ``items``, with the other columns these have. Both may have an
    item that is null."""
    listed = items.withColumnRenamed("item_id", "_item")
    return df.join(listed, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")


def assortment_profile(sales: DataFrame, top: int = TOP_ITEMS) -> DataFrame:
    """The ``top`` items by row count among those sold in every store, with their active days
    and mean quantity; equal row counts are ordered by item. Items are ranked by rows per store
    first. Dates are only told apart in the rows of those that are shown, for over all items
    there are almost as many groups with the date as rows."""
    shown = rows_of_items(sales.select("item_id", "date", "quantity"), _top_counts(sales, top))
    figures = shown.groupBy("item_id", "n_stores", "n_rows").agg(
        F.countDistinct("date").alias("active_days"), F.avg("quantity").alias("mean_quantity")
    )
    ordered = figures.orderBy(F.desc("n_rows"), "item_id")
    return ordered.select("item_id", "n_stores", "active_days", "n_rows", "mean_quantity")


def top_items(sales: DataFrame, top: int = TOP_ITEMS) -> DataFrame:
    """The ``top`` items by row count among those sold in every store."""
    return _top_counts(sales, top).select("item_id", "n_rows")


def select_items_semi(df: DataFrame, items: DataFrame) -> DataFrame:
    """Rows whose item is listed in ``items``."""
    return df.join(items.select("item_id"), "item_id", "left_semi")


def assortment_attribute_counts(catalog: DataFrame, items: DataFrame) -> DataFrame:
    """How many different values each item attribute takes over the listed items."""
    return select_items_semi(catalog, items).agg(
        *[F.countDistinct(c).alias(f"n_{c}") for c in ITEM_ATTRIBUTES]
    )


def dummies(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Replace ``column`` by one 0/1 column for each of ``values``, named ``column_value``, in
    value order. Nulls and other values give 0 throughout. The values become column names,
    so this is for a closed list; ``dummy_entries`` has no need of one."""
    flags = [
        F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{column}_{v}")
        for v in sorted(values)
    ]
    return df.select(*[c for c in df.columns if c != column], *flags)


def dummy_entries(df: DataFrame, column: str) -> DataFrame:
    """The ones of the 0/1 columns of any number of values: each row with a value, with the
    name of the column that would be 1 for it in place of ``column``."""
    name = F.concat(F.lit(f"{column}_"), F.col(column).cast("string")).alias("dummy")
    rest = [c for c in df.columns if c != column]
    return df.where(F.col(column).isNotNull()).select(*rest, name)
