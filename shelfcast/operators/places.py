"""Places of rows in a global order, for tables too long for one window partition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def with_place(
    df: DataFrame, order: list[Column], store_rows: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """The rows with ``place``, from 0, in an order that tells all of them apart. They are dealt
    out by ranges of the order, sorted and numbered where they lie; the driver adds up one count
    for each partition. ``store_rows`` writes a frame under a name and reads it back, so that
    ranges are drawn once."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = store_rows(dealt.withColumn("_at", F.monotonically_increasing_id()), "places")
    part = F.shiftright("_at", _ROW_BITS)
    starts, before = [], 0
    for number, size in sorted(map(tuple, rows.groupBy(part.alias("part")).count().collect())):
        starts.append((number, before))
        before += size
    first = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _first long"))
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = rows.join(first, part == F.col("_part")).withColumn("place", F.col("_first") + row)
    return placed.drop("_at", "_part", "_first")
