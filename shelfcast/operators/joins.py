"""Joins to the item and store tables, and the item by store grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.versions import join_as_of

def left_join_dimensions(facts: DataFrame, catalog: DataFrame, stores: DataFrame) -> DataFrame:
    """Add item and store attributes; rows without a match keep nulls. Both tables are to
    have one row per key, or one for any date where they carry the dates they hold from and to;
    those join as of the fact's date.

    Spark broadcasts a side whose size, from file statistics or measured by adaptive
    execution, is under ``spark.sql.autoBroadcastJoinThreshold``. A larger one is shuffled,
    and the rows of a hot item or store are on the left, the side of a left join that adaptive
    execution cuts. Nothing runs until the result is used.
    """
    return join_as_of(join_as_of(facts, catalog, "item_id"), stores, "store_id")


def item_store_grid(
    catalog: DataFrame, stores: DataFrame, buckets: int | None = None
) -> DataFrame:
    """Every item with every store. The pairs are the result asked for; they are formed by an
    equi-join on a bucket number: an item hashes to one bucket and the store ids are copied
    to each, so a task forms the pairs of its own items only and nothing is broadcast. A
    bucket is a partition by its number, not by a second hash, so none is empty or doubled
    by chance, and the fixed number keeps adaptive execution from merging tasks whose input
    is small and output large."""
    if buckets is None:
        session = catalog.sparkSession
        buckets = max(int(session.conf.get("spark.sql.shuffle.partitions")), 1)
    items = (
        catalog.select("item_id")
        .distinct()
        .withColumn("_bucket", F.pmod(F.xxhash64("item_id"), F.lit(buckets)).cast("int"))
        .repartitionById(buckets, F.col("_bucket"))
    )
    outlets = (
        stores.select("store_id")
        .distinct()
        .withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
        .repartitionById(buckets, F.col("_bucket"))
    )
    return items.join(outlets, "_bucket").select("item_id", "store_id")
