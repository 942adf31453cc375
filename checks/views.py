"""The retail tables as views over the star schema (see FIXTURES.md).

Four grains name what plays the item and the store:
TR  part type x region, BN  part brand x nation, PR  part x region, DY  odd and even parts in
one store, so that each series has a sale on every date.

But for PR, some lines are of an item, some of a store, that no dimension table lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PARITY = "concat('part ', p_partkey % 2)"
_ITEM = {"TR": "p_type", "BN": "p_brand", "PR": "cast(p_partkey AS string)", "DY": _PARITY}
_STORE = {"TR": "n_regionkey", "BN": "n_nationkey", "PR": "n_regionkey", "DY": "0"}
UNLISTED_ITEM, UNLISTED_STORE = "UNLISTED", -1

# Given, so that opening a table runs no job to infer them.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "lineitem": (
        "l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_shipdate timestamp_ntz"
    ),
}

FORECAST_START = "2001-07-01"
TRAINING_END = "2001-06-30"
PROCESS_DATE = "2001-07-01"


class Retail:
    """The retail tables of one data directory at one grain."""

    def __init__(self, spark: SparkSession, sf_dir: str, grain: str):
        self.spark, self.sf_dir, self.grain = spark, sf_dir, grain
        self._opened: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._opened:
            reader = self.spark.read.schema(_SCHEMAS[name])
            self._opened[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]

    def _lines(self, *columns: Column) -> DataFrame:
        """Line items keyed by (date, item_id, store_id). Part and supplier grow with the
        data, so how they are joined is left to Spark's size statistics and skew handling."""
        lines = self._table("lineitem")
        items = self._table("part").select(
            F.col("p_partkey").alias("l_partkey"),
            F.expr(_ITEM[self.grain]).alias("item_id"),
        )
        outlets = (
            self._table("supplier")
            .join(self._table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self._table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("l_suppkey"),
                F.expr(_STORE[self.grain]).alias("store_id"),
            )
        )
        item, store = F.col("item_id"), F.col("store_id")
        if self.grain != "PR":
            item = F.when(self._unlisted(5), UNLISTED_ITEM).otherwise(item).alias("item_id")
            store = F.when(self._unlisted(6), UNLISTED_STORE).otherwise(store).alias("store_id")
        return (
            lines.join(items, "l_partkey")
            .join(outlets, "l_suppkey")
            .select(F.col("l_shipdate").cast("date").alias("date"), item, store, *columns)
        )

    @staticmethod
    def _unlisted(number: int) -> Column:
        return (F.col("l_linenumber") == number) & (F.col("l_tax") == 0.08)

    @staticmethod
    def _unit_price() -> Column:
        return F.col("l_extendedprice") / F.col("l_quantity")

    def sales(self) -> DataFrame:
        return self._lines(
            F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("quantity"),
            F.when(F.col("l_tax") != 0.08, self._unit_price()).alias("price_base"),
            F.col("l_extendedprice").alias("sum_total"),
        )

    def markdowns(self) -> DataFrame:
        return self._lines(
            F.col("l_quantity").alias("quantity"),
            (self._unit_price() * (1 - F.col("l_discount"))).alias("price"),
            self._unit_price().alias("normal_price"),
            F.col("l_discount"),
        ).where("l_discount >= 0.08").drop("l_discount")

    def discounts(self) -> DataFrame:
        return self._lines(
            F.col("l_linenumber").cast("double").alias("promo_type_code"),
            (self._unit_price() * (1 - F.col("l_discount"))).alias("sale_price_time_promo"),
            self._unit_price().alias("sale_price_before_promo"),
            F.col("l_returnflag"),
        ).where("l_returnflag = 'R'").drop("l_returnflag")

    def prices(self) -> DataFrame:
        return self._lines(self._unit_price().alias("price"), F.col("l_returnflag")).where(
            "l_returnflag = 'A'"
        ).drop("l_returnflag")

    def catalog(self) -> DataFrame:
        other = "p_brand" if self.grain == "TR" else "p_type"
        return (
            self._table("part")
            .groupBy(F.expr(_ITEM[self.grain]).alias("item_id"))
            .agg(
                F.min(other).alias("dept_name"),
                F.max(other).alias("class_name"),
                F.min("p_name").alias("subclass_name"),
                F.max("p_name").alias("item_type"),
            )
        )

    def stores(self) -> DataFrame:
        nations = self._table("nation").join(
            self._table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        store = F.expr(_STORE[self.grain]).alias("store_id")
        parity = F.when(F.col("store_id") % 2 == 0, "even").otherwise("odd").alias("format")
        if self.grain == "BN":
            rows = nations.select(
                store,
                F.col("r_name").alias("division"),
                F.col("n_name").alias("city"),
                F.col("n_regionkey").cast("string").alias("area"),
            )
        else:
            rows = nations.groupBy(store).agg(
                F.min("r_name").alias("division"),
                F.min("n_name").alias("city"),
                F.count("n_nationkey").cast("string").alias("area"),
            )
        return rows.select("store_id", "division", parity, "city", "area")
