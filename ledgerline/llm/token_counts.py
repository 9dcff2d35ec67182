"""Exact histogram of encoded lengths, and what its suffix sums answer.

Documents are counted by length with map-side sums; beyond that only the
histogram, one row per distinct length, is handled. Its running sums are taken
within blocks of lengths and over the few block totals, never in one window.

Null and empty texts have length 0. Repeated rows count as often as they occur.
An empty table gives an empty histogram. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, slices
from ledgerline.llm.tokens import word_encoder

BLOCK = 1024


def lengths(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``length``: the number of ids of each document's text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(encoder.lengths(pc.fill_null(part.column("text"), "")))], ["length"]
                )

    return documents.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "length bigint")


def histogram(documents: DataFrame, tokenizer: str) -> DataFrame:
    """``length`` and ``n_docs``, written to the shared folder."""
    return materialize(lengths(documents, tokenizer).groupBy("length").agg(F.count("*").alias("n_docs")), "lengths")


def suffix_sums(counts: DataFrame) -> DataFrame:
    """For every context limit that is a length: what fits and what is cut.

    ``docs_over`` / ``tokens_over`` are of the documents longer than ``length``,
    ``docs_within`` / ``tokens_within`` of the others; ``truncated_total`` are the
    tokens left when each document is cut to ``length``; ``share_within`` is the
    quantile of ``length``.
    """
    rows = counts.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(above), zero).alias("docs_above"),
        F.coalesce(F.sum("block_tokens").over(above), zero).alias("tokens_above"),
        F.sum("block_docs").over(every).alias("all_docs"),
        F.sum("block_tokens").over(every).alias("all_tokens"),
    )
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    docs_over = F.col("docs_above") + F.coalesce(F.sum("n_docs").over(longer), zero)
    tokens_over = F.col("tokens_above") + F.coalesce(F.sum("tokens").over(longer), zero)
    return (
        rows.join(blocks, "block")
        .select("length", "n_docs", docs_over.alias("docs_over"), tokens_over.alias("tokens_over"), "all_docs", "all_tokens")
        .select(
            "length", "n_docs", "docs_over", "tokens_over",
            (F.col("all_docs") - F.col("docs_over")).alias("docs_within"),
            (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_within"),
            (F.col("all_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("truncated_total"),
            ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("share_within"),
        )
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """Tokens left when each document is cut to any ``limit``: one row ``truncated_total``."""
    # The longest length within the limit holds the suffix sums of all that is longer.
    within = F.when(F.col("length") <= limit, F.struct("length", "tokens_within", "docs_over"))
    row = sums.agg(F.max(within).alias("x"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"))
    cut = F.coalesce(F.col("x.tokens_within") + F.lit(limit) * F.col("x.docs_over"), F.lit(limit) * F.col("docs"))
    return row.select(cut.cast("bigint").alias("truncated_total"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """The least length that ``share`` of the documents do not exceed: one row ``length``."""
    return sums.where(F.col("share_within") >= share).agg(F.min("length").alias("length"))
