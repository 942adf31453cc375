"""Helpers shared by the operators: shared folders, written tables, text expressions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a temporary folder."""
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="llm-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors, once for each application, for sessions that were
    started without it in their ``--py-files``."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp(prefix="llm-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the column as text, modulo n; null for null."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(n))


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, everything else as it is. ``lower`` is the faster way where all
    characters are ASCII, and does the same there."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def hashed_share(key: Column, wanted: int, n: int) -> Column:
    """Whether a row is in a share of the rows, told by the hash of its key, that holds some
    four times the rows wanted of n; all rows if there are few. Taking the least hashes of such a
    share instead of the whole table bounds what meets in one task."""
    share = min(1.0, 4 * wanted / n) if n else 1.0
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(1 << 31)) < int(share * (1 << 31))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under names of its own."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
