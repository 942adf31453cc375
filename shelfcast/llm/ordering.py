"""Places of rows in a global order, without bringing the rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import written

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition


def numbered(df: DataFrame, keys: list[Column], name: str, place: str = "place") -> DataFrame:
    """The rows of ``df`` with their place, from 0, in the order of ``keys``. Rows that agree in
    every key follow each other in no stated order; give keys that tell apart what matters.

    A range shuffle deals the rows, each task sorts its own and numbers them, and the result is
    written once. What the driver then sees is one count for each partition. Spark reads ``df``
    twice, first for a sample to draw the ranges from, so give it a written table. Rows of equal
    keys meet in one task: end the keys with something that differs within a hot one.
    """
    spark = df.sparkSession
    at = f"_{place}"
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = written(dealt.withColumn(at, F.monotonically_increasing_id()), name)
    part = F.shiftright(at, _ROW_BITS)
    sizes = sorted(map(tuple, stored.groupBy(part.alias("part")).count().collect()))
    starts, before = [], 0
    for number, size in sizes:
        starts.append((number, before))
        before += size
    if not starts:
        return stored.drop(at).withColumn(place, F.lit(0).cast("long"))
    first = F.broadcast(spark.createDataFrame(starts, "_part long, _first long"))
    row = F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    joined = stored.join(first, part == F.col("_part"))
    return joined.withColumn(place, F.col("_first") + row).drop(at, "_part", "_first")
