"""Date-partitioned Parquet zones: writing, reading, pruning and listing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from shelfcast.functions.calendar import as_date, date_lit, date_parts, partition_path
from shelfcast.schemas import DATE_PARTS, SERIES

WRITE_MODES = ("replace_dates", "overwrite", "append")


def write_by_date(
    df: DataFrame, path: str, mode: str = "replace_dates", padded: bool = False
) -> None:
    """Write one directory per date.

    ``replace_dates`` replaces the dates present in ``df`` and keeps all others, so running a
    day again changes nothing; ``overwrite`` replaces the whole zone; ``append`` adds files.
    A frame without rows leaves a zone as it is under ``replace_dates``.

    Rows are brought together by date first, which keeps the number of files near the number
    of dates. The rebalance hint lets adaptive execution cut a heavy date into several tasks
    and merge light ones, so no date has to fit one task. The sort serves the partitioned
    writer, which needs the dates in order, and clusters series for row-group pruning.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    keyed = df.withColumns(date_parts(padded=padded))
    order = [c for c in SERIES if c in df.columns]
    writer = (
        keyed.hint("rebalance", *DATE_PARTS)
        .sortWithinPartitions(*DATE_PARTS, *order)
        .write.partitionBy(*DATE_PARTS)
    )
    if mode == "replace_dates":
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.option("partitionOverwriteMode", "static").mode(mode)
    writer.parquet(path)


def read_zone(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The whole zone, partition columns included. With its schema given no file is opened
    to find it out."""
    if schema is None:
        return spark.read.parquet(path)
    parts = [StructField(p, IntegerType()) for p in DATE_PARTS if p not in schema.names]
    return spark.read.schema(StructType([*schema.fields, *parts])).parquet(path)


def _partition_date():
    return F.make_date(*DATE_PARTS)


def between_dates(
    df: DataFrame, first: dt.date | str | None = None, last: dt.date | str | None = None
) -> DataFrame:
    """Rows dated ``first`` to ``last``, both included; a bound left out is open. On a zone
    the same bounds are put on the partition columns, so other dates are not opened; a date
    without a directory is just absent."""
    dated = [F.col("date")]
    if set(DATE_PARTS) <= set(df.columns):
        dated.append(_partition_date())
    for value in dated:
        if first is not None:
            df = df.where(value >= date_lit(first))
        if last is not None:
            df = df.where(value <= date_lit(last))
    return df


def on_dates(df: DataFrame, dates: Iterable[dt.date], keep: bool = True) -> DataFrame:
    """Rows of the named dates, or of all others. On a zone other dates are not opened."""
    named = ", ".join(f"DATE'{day:%Y-%m-%d}'" for day in sorted(dates))
    if not named:
        return df.where(F.lit(not keep))
    dated = ["date"]
    if set(DATE_PARTS) <= set(df.columns):
        dated.append(f"make_date({', '.join(DATE_PARTS)})")
    for value in dated:
        df = df.where(f"{value} {'' if keep else 'NOT '}IN ({named})")
    return df


def read_date(spark: SparkSession, path: str, day: dt.date | str, schema: StructType) -> DataFrame:
    """One date of a padded zone from its own folder, the zone around it not listed."""
    folder = f"{path}/{as_date(day):year=%Y/month=%m/day=%d}"
    return spark.read.schema(schema).parquet(folder)


def first_rows(df: DataFrame, order: list, n: int = 20) -> DataFrame:
    """A few rows to look at: the first by an order, which each task cuts for itself."""
    return df.orderBy(*order).limit(n)


def partition_row_count(zone: DataFrame, day: dt.date | str) -> DataFrame:
    """Number of rows in one date's directory."""
    return zone.where(_partition_date() == date_lit(day)).agg(F.count("*").alias("n_rows"))


def _no_such_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


# A record of a manifest is a folder ``version=N``: the dates it tells of and, where ``whole``, no
# others. Readers start from the last whole one, which names the record that each date is from.
_RECORD = "date date, n_rows long, source long, recorded long, whole boolean"
RECORDS = 32  # read together at most; the next record is a whole one


def _records(spark: SparkSession, manifest: str) -> DataFrame:
    """Records from the last whole one on; empty before the first landing."""
    schema = f"{_RECORD}, version long"
    try:
        found = spark.read.schema(schema).parquet(manifest)
    except AnalysisException as error:
        if not _no_such_path(error):
            raise
        return spark.createDataFrame([], schema)
    whole = found.where("whole").agg(F.max("version")).first()[0] or 0
    return found.where(F.col("version") >= whole)


def last_version(spark: SparkSession, manifest: str) -> int:
    """The number of the newest record, 0 before the first."""
    return _records(spark, manifest).agg(F.max("version")).first()[0] or 0


def per_date(zone: DataFrame) -> DataFrame:
    """Dates with their row counts, from the files' footers."""
    return zone.groupBy(_partition_date().alias("date")).agg(F.count("*").alias("n_rows"))


def record_dates(
    zone: DataFrame, manifest: str, mode: str = "append", source: int | None = None
) -> int:
    """Add the dates of ``zone`` with their row counts to a manifest, or begin it anew. Give it
    only the dates just written: their files are counted, which reads no data page."""
    return record_counts(per_date(zone), manifest, mode, source)


def record_counts(
    counts: DataFrame, manifest: str, mode: str = "append", source: int | None = None
) -> int:
    """Add (date, n_rows) to a manifest, or begin it anew, and return the number of the record.
    ``source`` is the number of the record of another zone that the dates were made from.

    Numbers count up, whatever the clocks of the machines say, also where a manifest begins anew.
    A number that is taken raises, so of two jobs that record at once one is run again. Every
    ``RECORDS`` records a whole one is written and the older ones go.
    """
    spark = counts.sparkSession
    earlier = _records(spark, manifest)
    numbers = sorted(r[0] for r in earlier.select("version").distinct().collect())
    version = (numbers[-1] if numbers else 0) + 1
    rows = counts.select(
        "date",
        "n_rows",
        F.lit(source).cast("long").alias("source"),
        F.lit(version).cast("long").alias("recorded"),
    )
    whole = mode == "overwrite"
    if not whole and len(numbers) >= RECORDS:
        others = _latest(earlier).withColumnRenamed("version", "recorded")
        others = others.join(rows.select("date"), "date", "left_anti").select(*rows.columns)
        rows, whole = others.unionByName(rows), True
    rows = rows.withColumn("whole", F.lit(whole))
    # An empty record still counts: one row without a date stands for it.
    empty = spark.createDataFrame([(None, 0, source, version, whole)], _RECORD)
    rows.unionByName(empty).coalesce(1).write.parquet(f"{manifest}/version={version}")
    if whole:
        for old in numbers:
            remove_folder(spark, f"{manifest}/version={old}")
    return version


def _latest(records: DataFrame) -> DataFrame:
    found = records.where("date IS NOT NULL").groupBy("date")
    newest = F.max_by(F.struct("n_rows", "source", "recorded"), "version").alias("newest")
    return found.agg(newest).select("date", "newest.*").withColumnRenamed("recorded", "version")


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Dates with their directory, row count, and the numbers of their last record and of what
    they were made from; empty before the first landing. A date that was recorded without rows is
    not there."""
    latest = _latest(_records(spark, manifest)).where("n_rows > 0")
    return latest.select("date", partition_path().alias("path"), "n_rows", "version", "source")


def stale_dates(source: DataFrame, made: DataFrame) -> DataFrame:
    """Dates of one manifest that were recorded after what another's zone was made from, or that
    it does not have."""
    known = made.select("date", F.col("source").alias("_made_from"))
    joined = source.join(known, "date", "left")
    late = F.col("_made_from").isNull() | (F.col("_made_from") < F.col("version"))
    return joined.where(late).select("date")


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _file_system(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = _file_system(spark, path)
    files.delete(folder, True)


def replace_folder(spark: SparkSession, new: str, live: str) -> None:
    """Put a finished folder in the place of another, which stands beside it until then."""
    source, files = _file_system(spark, new)
    target, _ = _file_system(spark, live)
    aside, _ = _file_system(spark, f"{live}-replaced")
    files.delete(aside, True)
    if files.exists(target) and not files.rename(target, aside):
        raise OSError(f"{live} could not be put aside")
    if not files.rename(source, target):
        raise OSError(f"{new} could not be put in place; the older one is at {live}-replaced")
    files.delete(aside, True)


def remove_dates(spark: SparkSession, path: str, dates: Iterable[dt.date]) -> None:
    """Delete the directories of some dates of a padded zone."""
    for day in dates:
        remove_folder(spark, f"{path}/{day:year=%Y/month=%m/day=%d}")


def last_date(dates: DataFrame) -> DataFrame:
    """Latest date of a manifest, or of any frame with a date. From a manifest no file of the
    zone is opened."""
    return dates.agg(F.max("date").alias("last_date"))


def next_dates(dates: DataFrame) -> DataFrame:
    """The date to process next and the first date to forecast after it. The cursor is what
    the manifest holds, so a failed run does not move it."""
    return last_date(dates).select(
        F.date_add("last_date", 1).alias("process_date"),
        F.date_add("last_date", 2).alias("forecast_start"),
    )


def partition_manifest(df: DataFrame) -> DataFrame:
    """Dates with their directory and row count, in date order."""
    return (
        df.groupBy("date")
        .agg(F.count("*").alias("n_rows"))
        .select("date", partition_path().alias("path"), "n_rows")
        .orderBy("date")
    )
