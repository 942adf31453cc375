"""The operators as queries over the given tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import crc_mod, ship_package, table, written
from shelfcast.llm.cover_tree import top_k
from shelfcast.llm.decontaminate import scan_columns
from shelfcast.llm.embedding_dedup import embedding_links
from shelfcast.llm.language import fit_languages, language_column
from shelfcast.llm.licenses import fit_licenses, license_column
from shelfcast.llm.line_dedup import dedup_lines
from shelfcast.llm.merkle import build_manifest, document_leaves
from shelfcast.llm.quality import Ftrl, fit_quality, score_column
from shelfcast.llm.resampling import importance_ranks
from shelfcast.llm.sentencepiece_table import encode_documents
from shelfcast.llm.simhash import simhash_components
from shelfcast.llm.training_order import Layout, materialise
from shelfcast.llm.warc import build_derivatives, record_text, responses_of_pages

PIECES = public_tokenizers.path("piece_bpe_32k.model")
LAYOUT = Layout(
    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, end_id=50256
)


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records for each page, with sizes and digests of what is written."""
    responses = responses_of_pages(table(spark, sf_dir, "pages"))
    records = record_text(build_derivatives(responses))
    return records.select(
        F.col("source_headers")["page-id"].cast("long").alias("page_id"),
        "record_type",
        "record_id",
        "refers_to",
        "target_uri",
        "source_payload_digest",
        F.length("block").cast("long").alias("n_chars"),
        "block_digest",
        F.sha2("warc", 256).alias("record_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("deduped.n_lines").alias("n_lines"),
        F.col("deduped.n_dropped").alias("n_dropped"),
        F.sha2("deduped.text", 256).alias("kept_sha256"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_columns(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("contamination.items", lambda i: i.cast("string")))
    n_hit = F.size("contamination.hit").cast("long")
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families confirmed by a template and families only predicted, for each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select(
        "doc_id", license_column(docs, F.col("text"), fit_licenses(docs)).alias("found")
    )

    def families(confirmed: bool):
        of = F.filter("found", lambda x: x["confirmed"] == confirmed)
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda x: x["family"]))), ",")

    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_paragraphs"),
        families(True).alias("licenses"),
        families(False).alias("unconfirmed"),
        F.array_max(F.transform("found", lambda x: x["probability"])).alias("probability"),
    )


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str):
    params = Ftrl()
    learn = crc_mod(F.col("id"), 5) != 0
    weights = fit_quality(docs, table(spark, sf_dir, "labels"), usable=learn, params=params)
    return score_column(docs, F.col("text"), weights, params.bits)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = docs.select("doc_id", _quality(spark, docs, sf_dir).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit_languages(docs.where(~held_out))
    found = docs.select("doc_id", language_column(docs, "text", model).alias("found"))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("found.nearest").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.rejected").alias("rejected"),
    )


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the shards written."""
    _, manifest = materialise(table(spark, sf_dir, "documents"), LAYOUT)
    return manifest


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_documents(docs, PIECES, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_links(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return importance_ranks(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf with its proof; every third document, by hash, tampered with."""
    docs = table(spark, sf_dir, "documents")
    leaves = written(document_leaves(docs, tampered=crc_mod(F.col("doc_id"), 3) == 0), "leaves")
    proofs = build_manifest(leaves, ["doc_id"]).proofs({"folded_root": "claim"})
    return proofs.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _query(f):
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _query(f)
    for f in (
        op1_warc_derivatives,
        op2_line_dedup,
        op3_decontaminate,
        op4_simhash,
        op5_license_scan,
        op6_quality,
        op7_language,
        op8_training_order,
        op9_sentencepiece,
        op10_embedding_dedup,
        op11_importance_resampling,
        op12_merkle_manifest,
        op13_top_k,
        pipeline,
    )
}
