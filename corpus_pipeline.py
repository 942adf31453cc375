"""A corpus pipeline: documents through five of the operators, each stage written and reread."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import crc_mod, shared_path, ship_package, table
from shelfcast.llm.decontaminate import scan_columns
from shelfcast.llm.line_dedup import dedup_lines
from shelfcast.llm.quality import Ftrl, fit_quality, score_column
from shelfcast.llm.queries import PIECES
from shelfcast.llm.sentencepiece_table import encode_documents
from shelfcast.llm.simhash import simhash_components


def _stage(f):
    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, docs, sf_dir)

    return run


def _with_text(docs: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` in their order, with another text and its length."""
    changed = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more. Learnt as in the query, from rows that it does not hold out."""
    params = Ftrl()
    learn = crc_mod(F.col("id"), 5) != 0
    weights = fit_quality(docs, table(spark, sf_dir, "labels"), usable=learn, params=params)
    return docs.where(score_column(docs, F.col("text"), weights, params.bits) >= 0.3)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat. None goes, even if no line is left."""
    found = dedup_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("deduped.text"))
    return _with_text(found, text).drop("deduped")


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group. Rows that repeat its id with the same text
    are one row, the least by the other columns; other texts under that id are no copies by the
    id alone and stay. Rows without an id stay."""
    kept = simhash_components(docs).where(F.col("doc_id") == F.col("component_id"))
    named = docs.where(F.col("doc_id").isNotNull())
    one = named.join(kept.select("doc_id").distinct(), "doc_id", "left_semi")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    least = one.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0), *rest)).alias("_least"))
    columns = [F.col(c) if c in ("doc_id", "text") else F.col(f"_least.`{c}`").alias(c) for c in docs.columns]
    return least.select(*columns).unionByName(docs.where(F.col("doc_id").isNull()))


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = scan_columns(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("contamination.hit") == 0).drop("contamination")


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with digests of them and of what they decode to."""
    return encode_documents(docs, PIECES, ("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

# The classifier is learnt by floating-point updates, and the pieces by a library: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"stage-{n}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
