"""Landing sales files as they arrive, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from shelfcast.functions.calendar import parse_date
from shelfcast.plans.jobs import correct_features, manifest_path
from shelfcast.schemas import SALES, conform
from shelfcast.sources.zones import (
    folder_exists,
    on_dates,
    read_manifest,
    read_zone,
    record_dates,
    write_by_date,
)

BASE = "landed before"  # in place of a file name: rows a date had when its first file came


def arriving_sales(spark: SparkSession, source: str, files_at_once: int | None = None) -> DataFrame:
    """Sales of the CSV files (``*.csv``) that a folder gets, with the file each row is from. The
    files have a header that names the sales columns in their order; another header raises."""
    text = StructType([StructField(name, StringType()) for name in SALES.names])
    reader = spark.readStream.schema(text).option("header", True).option("enforceSchema", False)
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    rows = reader.option("pathGlobFilter", "*.csv").csv(source)
    rows = rows.withColumn("file", F.col("_metadata.file_path")).withColumn("date", parse_date(F.col("date")))
    return conform(rows, SALES, keep_rest=True)


def _digests(arrivals: DataFrame) -> DataFrame:
    """What the rows of each file are, whatever its name and their order."""
    content = F.sum(F.xxhash64(*SALES.names).cast("decimal(38,0)"))
    other = F.sum(F.xxhash64(F.lit(1), *SALES.names).cast("decimal(38,0)"))
    return arrivals.groupBy("file").agg(
        F.count("*").alias("n_rows"), content.alias("digest"), other.alias("second_digest")
    )


_SAME = ["n_rows", "digest", "second_digest"]


def _ledger(spark: SparkSession, root: str, schema=None) -> DataFrame:
    return spark.read.schema(
        "file string, n_rows long, digest decimal(38,0), second_digest decimal(38,0), "
        "counts boolean, batch long"
    ).parquet(f"{root}/arrivals/files")


def _arrivals(spark: SparkSession, root: str) -> DataFrame:
    """All rows kept so far of files that count."""
    schema = StructType([*SALES.fields, StructField("file", StringType())])
    rows = spark.read.schema(schema).parquet(f"{root}/arrivals/rows/batch=*")
    counting = _ledger(spark, root).where("counts").select("file")
    return rows.join(counting, "file", "left_semi")


def land_batch(batch: DataFrame, number: int, root: str, build: bool = True) -> list:
    """Land one micro-batch, and return the dates it touched.

    Its rows are kept under their batch number, and each date they touch is landed as all rows
    kept for it: what came before, in whatever batch, and this. So a late file adds to its date,
    and a batch that fails anywhere is just run again. A file whose rows were delivered before
    under another name counts once. Rows that a date had before its first file are kept too, with
    the first batch that touches it; the zone is only changed once that is written in full.
    With ``build`` the features of those dates, and of all that they reach, are built once.
    """
    spark = batch.sparkSession
    kept, files = f"{root}/arrivals/rows/batch={number}", f"{root}/arrivals/files/batch={number}"
    sales, manifest = f"{root}/sales", manifest_path(root, "sales")
    if not folder_exists(spark, f"{files}/_SUCCESS"):
        first = number == 0 or not folder_exists(spark, f"{root}/arrivals/files")
        rows = batch.where("date IS NOT NULL")
        dates = {r["date"] for r in rows.select("date").distinct().collect()}
        known = set()
        if not first:
            earlier = on_dates(_arrivals(spark, root), dates).select("date").distinct()
            known = {r["date"] for r in earlier.collect()}
        landed = {r["date"] for r in on_dates(read_manifest(spark, manifest), dates - known).collect()}
        if landed:
            base = on_dates(read_zone(spark, sales, SALES), landed).select(*SALES.names)
            rows = rows.unionByName(base.withColumn("file", F.lit(f"{BASE} {number}")))
        rows.repartitionByRange("date").sortWithinPartitions("date").write.mode("overwrite").parquet(kept)
        digests = _digests(spark.read.schema(rows.schema).parquet(kept))
        is_base = F.col("file").startswith(BASE)
        named = digests.groupBy(*_SAME, is_base.alias("base")).agg(F.min("file").alias("least"))
        counted = digests.withColumn("base", is_base).join(named, [*_SAME, "base"])
        counted = counted.withColumn("counts", F.col("file") == F.col("least"))
        if not first:
            before = _ledger(spark, root).where("counts").where(~F.col("file").startswith(BASE))
            before = before.select(*_SAME, F.lit(True).alias("seen"))
            counted = counted.join(before, _SAME, "left").withColumn(
                "counts", F.col("counts") & (F.col("base") | F.col("seen").isNull())
            )
        ledger = counted.select("file", *_SAME, "counts")
        ledger.coalesce(1).write.mode("overwrite").parquet(files)
    mine = spark.read.schema(SALES).parquet(kept)
    dates = sorted(r["date"] for r in mine.select("date").distinct().collect())
    if not dates:
        return dates
    rows = on_dates(_arrivals(spark, root), dates).select(*SALES.names)
    write_by_date(rows, sales, padded=True)
    record_dates(on_dates(read_zone(spark, sales, SALES), dates), manifest)
    if build:
        correct_features(spark, root, until=dates[-1])
    return dates


def land_stream(
    spark: SparkSession,
    source: str,
    root: str,
    build: bool = True,
    files_at_once: int | None = None,
) -> StreamingQuery:
    """Land the files that are in a folder and have not been landed, then stop; started again,
    it goes on where it stopped. What was seen is kept under ``root``. Features are built into
    a zone that has some already."""
    arrivals = arriving_sales(spark, source, files_at_once)
    return (
        arrivals.writeStream.foreachBatch(lambda df, n: _land(df, n, root, build))
        .option("checkpointLocation", f"{root}/arrivals/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _land(batch: DataFrame, number: int, root: str, build: bool) -> None:
    land_batch(batch, number, root, build)
