"""Rewriting the dates of a zone that have more files than their size asks for."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.schemas import DATE_PARTS, SERIES
from shelfcast.sources.zones import on_dates, read_zone

FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class DateFiles:
    """A date to be rewritten: its files and bytes as they are, and the files it is to have."""

    day: dt.date
    n_files: int
    n_bytes: int
    wanted: int


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Dates of a zone with the number and bytes of their files, from the listing alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    parts = [F.col(p).cast("int") for p in DATE_PARTS]
    return listed.groupBy(F.make_date(*parts).alias("date")).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")
    )


def compaction_plan(
    spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, slack: float = 2.0
) -> list[DateFiles]:
    """The dates with more than ``slack`` times the files that ``file_bytes`` a file would make."""
    wanted = F.greatest(F.ceil(F.col("n_bytes") / file_bytes), F.lit(1)).alias("wanted")
    many = file_sizes(spark, path).select("date", "n_files", "n_bytes", wanted)
    found = many.where(F.col("n_files") > F.col("wanted") * slack).where("date IS NOT NULL")
    return [DateFiles(*row) for row in sorted(map(tuple, found.collect()))]


def pack(plan: list[DateFiles], file_bytes: int = FILE_BYTES) -> list[tuple[dt.date, int, int]]:
    """(date, part, task): each date in its wanted number of parts, parts put together into tasks
    of some ``file_bytes``, in date order."""
    packed, filled, task = [], 0.0, 0
    for one in plan:
        share = one.n_bytes / one.wanted
        for part in range(one.wanted):
            if filled and filled + share > file_bytes:
                task, filled = task + 1, 0.0
            packed.append((one.day, part, task))
            filled += share
    return packed


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    file_bytes: int = FILE_BYTES,
    slack: float = 2.0,
) -> list[dt.date]:
    """Rewrite the dates of the plan, each into as many files as its bytes ask for, and leave all
    others untouched. Rows go to a part of their date by a hash of the whole row, so a heavy date
    or series is spread evenly; several light dates share a task. Returns the dates."""
    plan = compaction_plan(spark, path, file_bytes, slack)
    if not plan:
        return []
    packed = pack(plan, file_bytes)
    tasks = max(task for _, _, task in packed) + 1
    wanted = spark.createDataFrame([(p.day, p.wanted) for p in plan], "date date, _wanted int")
    places = spark.createDataFrame(packed, "date date, _part int, _task int")
    zone = read_zone(spark, path, schema)
    dates = [p.day for p in plan]
    rows = on_dates(zone, dates).join(F.broadcast(wanted), "date")
    part = F.pmod(F.xxhash64(*schema.names), F.col("_wanted")).cast("int")
    rows = rows.withColumn("_part", part).join(F.broadcast(places), ["date", "_part"])
    order = [*DATE_PARTS, "_part", *[c for c in SERIES if c in schema.names]]
    dealt = rows.repartitionById(tasks, F.col("_task")).sortWithinPartitions(*order)
    parts = {p: F.col(p) for p in DATE_PARTS}
    if _padded(spark, path):
        parts = {"month": F.lpad(F.col("month").cast("string"), 2, "0"), "day": F.lpad(F.col("day").cast("string"), 2, "0")}
    names = list(dict.fromkeys([*schema.names, *DATE_PARTS]))
    writer = dealt.withColumns(parts).select(*names).write.partitionBy(*DATE_PARTS)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return dates


def _padded(spark: SparkSession, path: str) -> bool:
    """Whether the folders of a zone are named ``month=08`` rather than ``month=8``; of a zone in
    which both would be named alike, no."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return not listed.where(F.col("path").rlike("(month|day)=0")).isEmpty()
