"""Building blocks for work by key that hold when one key owns a third of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``, which must decide between any two
    rows that differ.

    Spark plans ``row_number() = 1`` with a group limit in front of the shuffle:
    a map task sends at most one row per key, however often the key occurs.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Each key once. Deduplicates inside the map tasks before it shuffles."""
    return df.select(*keys).distinct()


def surplus(rows: DataFrame, kept: DataFrame, count: str = "copies") -> DataFrame:
    """Rows of ``rows`` left over once each row of ``kept`` is taken out once.

    Equal rows come back as one row with their number in ``count``. Grouping on
    the whole row spreads a hot key over all tasks, and equal rows collapse
    inside the map tasks before the shuffle.
    """
    names = rows.columns
    signed = rows.withColumn(count, F.lit(1).cast("bigint")).unionByName(
        kept.select(*names).withColumn(count, F.lit(-1).cast("bigint"))
    )
    return signed.groupBy(*names).agg(F.sum(count).alias(count)).where(F.col(count) > 0)
