"""CSV and Parquet tables outside the date-partitioned zones."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from shelfcast.functions.calendar import parse_date
from shelfcast.functions.cleaning import drop_stray_index
from shelfcast.operators.versions import VALIDITY, current, merge_versions
from shelfcast.schemas import DIMENSION_KEYS, SALES, STATIC_TABLES, conform
from shelfcast.sources.zones import folder_exists, read_zone, replace_folder, write_by_date


def read_csv(
    spark: SparkSession, path: str, schema: StructType, keep_rest: bool = False
) -> DataFrame:
    """A CSV file or folder with a header. Columns are found by header name, so their order
    in the file and stray index columns do not matter, and typed from ``schema`` instead of
    by a second pass over the data. Columns outside the schema stay text if kept. The files
    of a folder have to share one header: one that differs raises, so that no column can
    take another's values."""
    text = drop_stray_index(spark.read.csv(path, header=True, enforceSchema=False))
    dates = {
        f.name: parse_date(F.col(f.name)) for f in schema if isinstance(f.dataType, DateType)
    }
    return conform(text.withColumns(dates) if dates else text, schema, keep_rest)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """Sales from a CSV file or folder, told by the suffix, or from Parquet, dated zones too."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return read_csv(spark, path, SALES)
    return conform(spark.read.parquet(path), SALES)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def _land_table(df: DataFrame, path: str, mode: str) -> None:
    if "date" in df.columns:
        write_by_date(df, path, mode=mode)
    else:
        df.write.mode("overwrite").parquet(path)


def land_static(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Write the side tables under ``root``. Tables with a date become date-partitioned
    zones, so that the daily jobs open only the dates they use; the rest plain Parquet. The mode
    ``replace_dates`` keeps the dates of a dated table that are not among the rows. The
    writes are independent jobs and run at once, so one fills the slots another's last tasks
    leave idle."""
    if not tables:
        return
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [pool.submit(_land_table, df, f"{root}/{name}", mode) for name, df in tables.items()]
        for job in jobs:
            job.result()


def read_static(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One side table as landed: the schema's columns, and the date parts of a dated table so
    that ``between_dates`` can prune. Of items and stores the rows that hold now."""
    schema = STATIC_TABLES[name]
    if "date" in schema.names:
        return read_zone(spark, f"{root}/{name}", schema)
    return current(read_versions(spark, root, name))


def read_versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Items or stores as versions with the dates they hold from and to, open on both sides where
    they were landed without."""
    dated = [StructField(c, DateType()) for c in VALIDITY]
    schema = StructType([*STATIC_TABLES[name].fields, *dated])
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def land_versions(arrived: DataFrame, root: str, name: str, day: str | dt.date) -> None:
    """Items or stores that hold from a day on, merged by key into those landed before. The
    merged table is written beside the old one and then takes its place."""
    spark, path = arrived.sparkSession, f"{root}/{name}"
    if not folder_exists(spark, path):
        arrived.write.parquet(path)
        return
    merged = merge_versions(read_versions(spark, root, name), arrived, DIMENSION_KEYS[name], day)
    beside = f"{path}-{uuid.uuid4().hex}"
    merged.write.parquet(beside)
    replace_folder(spark, beside, path)
