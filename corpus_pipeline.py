"""The corpus pipeline: stages from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontamination, disclosure, packing, quality, signature_trees
from ledgerline.llm.common import materialize
from ledgerline.llm.tokens import public_tokenizer


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail are cut, documents that lose too much go."""
    return quality.clean(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return signature_trees.one_of_each(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words from the benchmark go."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked, terms that give it away removed or generalised."""
    return disclosure.sanitise(docs)


def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces with their sequences and places there."""
    return packing.pack(docs, public_tokenizer())


STAGES = [
    ("quality rules", _quality),
    ("n-gram Jaccard join", _near_duplicates),
    ("benchmark decontamination", _decontamination),
    ("PII", _personal_data),
    ("best-fit packing", _packing),
]

# The line rules, the disclosure of terms and the tokenizer are not within SQL's reach.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
