"""Forecast sinks. Rows go from the executors to the sink; none pass through the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.calendar import as_date
from shelfcast.sources.zones import remove_folder

# Fixed value: the name readers of the forecasts expect.
FORECAST_TABLE = "daily_product_store_forecasts"


def forecast_path(root: str, start: str | dt.date) -> str:
    return f"{root}/{as_date(start):year=%Y/month=%m/day=%d}"


def publish_parquet(forecast: DataFrame, root: str, start: str | dt.date) -> str:
    """Write under the directory of the start date, replacing an earlier run for it."""
    path = forecast_path(root, start)
    forecast.write.mode("overwrite").parquet(path)
    return path


def publish_table(
    forecast: DataFrame, table: str = FORECAST_TABLE, path: str | None = None
) -> None:
    """Replace the whole catalog table."""
    writer = forecast.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


KEPT_VERSIONS = 3


def published_versions(spark: SparkSession, root: str, name: str = FORECAST_TABLE) -> list[int]:
    """Numbers of the versions that are there in full, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [status.getPath() for status in files.listStatus(folder)]
    whole = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().removeprefix("version=")) for p in whole)


def switch_version(spark: SparkSession, root: str, version: int, name: str = FORECAST_TABLE) -> None:
    """Make a published version the one that readers of ``name`` see, in one step: the name is a
    view, and replacing it changes the catalog alone."""
    path = f"{root}/{name}/version={version}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def publish_version(
    forecast: DataFrame, root: str, name: str = FORECAST_TABLE, keep: int = KEPT_VERSIONS
) -> int:
    """Write a version of its own beside those before it, and then switch the name to it. A job
    that fails before the switch leaves readers with what they had; the last ``keep`` versions
    stay to go back to. A table that has the name already is replaced by the view once the new
    version is written. Returns the version's number."""
    spark = forecast.sparkSession
    earlier = published_versions(spark, root, name)
    version = int(dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f"))
    version = max(version, earlier[-1] + 1 if earlier else 0)
    forecast.write.parquet(f"{root}/{name}/version={version}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    switch_version(spark, root, version, name)
    for old in [*earlier, version][:-keep]:
        remove_folder(spark, f"{root}/{name}/version={old}")
    return version


def publish_jdbc(
    forecast: DataFrame,
    url: str,
    jdbc_table: str = FORECAST_TABLE,
    connections: int = 16,
    batch: int = 10_000,
    **options: str,
) -> None:
    """Replace the whole relational table. Each partition inserts in batches over its own
    connection and coalescing bounds their number. Coalescing narrows everything up to the
    last shuffle, so pass forecasts read back from ``publish_parquet``, not a scoring plan."""
    (
        forecast.coalesce(connections)
        .write.format("jdbc")
        .options(url=url, dbtable=jdbc_table, batchsize=batch, **options)
        .mode("overwrite")
        .save()
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Rows and units per forecast date."""
    return forecast.groupBy("date").agg(
        F.count("*").alias("n_rows"), F.sum("predicted_quantity").alias("units")
    )
