"""The registered queries of the text operators: ``name -> function(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    collocations,
    decontamination,
    disclosure,
    html_blocks,
    licenses,
    merkle,
    order_minhash,
    packing,
    quality,
    sharding,
    signature_trees,
    token_counts,
    warc,
)
from ledgerline.llm.tokens import public_tokenizer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizer())


def op3_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op4_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.spans(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(disclosure.n_of(kind).alias(f"n_{kind}") for kind in disclosure.KINDS),
        F.sha2(disclosure.span_list(F.col("base")), 256).alias("base_sha256"),
        disclosure.span_list(F.concat("base", "terms")).alias("spans"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.histogram(_table(spark, sf_dir, "documents"), public_tokenizer()))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(_table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_trees.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.overlap(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(_table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_best_fit_packing,
        op3_extendible_sharding,
        op4_warc_normaliser,
        op5_pii_disclosure,
        op6_token_counts,
        op7_license_scan,
        op8_quality_rules,
        op9_ngram_jaccard_join,
        op10_benchmark_decontamination,
        op11_merkle_manifest,
        op12_phrase_collocations,
        op13_order_minhash,
    )
}
