"""Places of rows in sorted groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import dealt, materialize


def numbered(rows: DataFrame, group: str, *order: str) -> tuple[DataFrame, list[DataFrame]]:
    """``rows`` with ``place``, their place from 0 within ``group`` (nulls are one group) by ``order``, and ``group_size``.

    The second result are the tables that it reads; ``rows`` must be a written one.
    No window takes all rows of a group: rows are sorted by ranges, numbered inside
    their range, and moved by the number of rows in the ranges before. Equal rows are
    parted by their number in the scan, so that any number of copies is spread.
    """
    number = F.monotonically_increasing_id()
    own = rows.withColumn("_tie", number).repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order, "_tie")
    # The number inside a range is kept with the rows: read again, they may be cut otherwise.
    own = materialize(
        own.withColumn("_number", number).withColumn("_range", F.shiftright("_number", 33)).drop("_tie"), "ranks-sorted"
    )
    ranges = own.groupBy(group, "_range").agg(F.min("_number").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_range")
    ranges = ranges.select(
        F.col(group).alias("_group"),
        F.col("_range").alias("_in"),
        (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_move"),
        F.sum("_n").over(Window.partitionBy(group)).alias("group_size"),
    )
    # A row for each group in each range: few beside the rows, or as many where every group is small.
    ranges = materialize(ranges, "ranks-ranges")
    match = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_in"))
    name_bytes = F.coalesce(F.octet_length(F.col("_group").cast("string")), F.lit(0))
    placed = own.join(dealt(ranges, name_bytes + 64), match).withColumn("place", F.col("_number") + F.col("_move"))
    return placed.drop("_number", "_range", "_group", "_in", "_move"), [own, ranges]
