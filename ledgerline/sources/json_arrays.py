"""JSON arrays of objects that span lines, each document read by many tasks.

The text is cut after every ``}``, which Spark's line reader does in any byte range
of a file. A piece's effect on the state of the parser is told from the piece alone:
whether it ends inside a string, given where it begins, and by how many levels the
depth changes in either case. Effects are added up inside each byte range; the sums
of the ranges, one row each, are added up in order of the ranges and tell in which
state every range begins. So the end of every record is known without reading what
stands before, also if a string or a record goes on over several ranges.

A ``}`` in a string and the end of an inner object are no end of a record. A record
that is no valid JSON, or that a document cut short leaves open, is a damaged
record by itself; values of the array that are no objects are a part of the next
record and damage it. A quotation mark too few turns the rest of its document
into damaged records. A top-level object is one record. Empty files and arrays have
none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ledgerline.operators.quality import CORRUPT
from ledgerline.session import shared_folder
from ledgerline.sinks import files

_STRING = r'"[^"]*(?:"|\z)'
_STRING_END = r'\A[^"]*(?:"|\z)'
_RANGE = ("file", "first_byte")


def _levels(outside: Column) -> Column:
    """Brackets opened and not closed in text without strings; it holds no closing brace."""
    return F.length(F.regexp_replace(outside, r"[^{\[]", "")) - F.length(F.regexp_replace(outside, r"[^\]]", ""))


def pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text between closing braces, by byte range and place there, with its effects.

    ``flips`` tells whether the piece changes between outside and inside a string;
    ``outside`` and ``inside`` are the changes of depth, with the brace at its end, of
    a piece that begins outside or inside of one.
    """
    meta = F.col("_metadata")
    rows = spark.read.option("lineSep", "}").text(path).select(
        "value", meta["file_path"].alias("file"), meta["file_size"].alias("file_size"),
        meta["file_block_start"].alias("first_byte"), F.monotonically_increasing_id().alias("place"),
    )
    rows = rows.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    flips = (F.length("bare") - F.length(F.replace("bare", F.lit('"'), F.lit("")))) % 2
    rest = F.regexp_replace("bare", _STRING_END, "")
    rows = rows.withColumn("flips", flips)
    return rows.select(
        "value", "file", "file_size", "first_byte", "place", "flips",
        (_levels(F.regexp_replace("bare", _STRING, "")) - (1 - F.col("flips"))).alias("outside"),
        (_levels(F.regexp_replace(rest, _STRING, "")) - F.col("flips")).alias("inside"),
    )


def _before(value: str, over: Window) -> Column:
    """The sum of the rows before."""
    return F.coalesce(F.sum(value).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _in_ranges(rows: DataFrame) -> DataFrame:
    """Pieces with ``flipped``, the changes before in their range, and the depth behind them if the range begins outside or inside."""
    order = Window.partitionBy(*_RANGE).orderBy("place")
    rows = rows.withColumn("flipped", _before("flips", order) % 2)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = lambda a, b: F.when(F.col("flipped") == 0, F.col(a)).otherwise(F.col(b))
    return rows.withColumns(
        {"depth_outside": F.sum(own("outside", "inside")).over(upto), "depth_inside": F.sum(own("inside", "outside")).over(upto)}
    )


def _begins(rows: DataFrame) -> DataFrame:
    """For each byte range whether it begins inside a string, at which depth, and the depth of its file's records.

    The windows take the ranges of a file, one row for each.
    """
    sums = rows.groupBy(*_RANGE).agg(
        (F.sum("flips") % 2).alias("flips"),
        F.max_by("depth_outside", "place").alias("outside"), F.max_by("depth_inside", "place").alias("inside"),
        F.min_by("value", "place").alias("head"),
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.first("file_size").alias("file_size"),
    )
    order = Window.partitionBy("file").orderBy("first_byte")
    whole = Window.partitionBy("file")
    sums = sums.withColumn("within", _before("flips", order) % 2)
    sums = sums.withColumn("change", F.when(F.col("within") == 0, F.col("outside")).otherwise(F.col("inside")))
    head = F.first("head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # Without a brace at its end the file is a byte shorter; a byte order mark of three is not among the values.
    spare = F.col("file_size") - F.sum("bytes").over(whole)
    return sums.select(
        *_RANGE, "within", _before("change", order).alias("depth"),
        F.when(F.ltrim(F.regexp_replace(head, r"\A[\s﻿]+", "")).startswith("["), 1).otherwise(0).alias("base"),
        spare.isin(0, 3).alias("braced"),
        F.row_number().over(Window.partitionBy("file").orderBy(F.col("first_byte").desc())).alias("from_end"),
    )


def _numbered(rows: DataFrame, begins: DataFrame) -> DataFrame:
    """Pieces with the number of their record in their range, ``record``, and whether they end it."""
    rows = rows.join(begins, list(_RANGE))
    inside = (F.col("within") + F.col("flipped") + F.col("flips")) % 2 == 1
    depth = F.col("depth") + F.when(F.col("within") == 0, F.col("depth_outside")).otherwise(F.col("depth_inside"))
    order = Window.partitionBy(*_RANGE).orderBy("place")
    last = (F.col("from_end") == 1) & F.lead("place").over(order).isNull() & ~F.col("braced")
    rows = rows.withColumn("ends", (~inside & (depth <= F.col("base")) & ~last).cast("int")).withColumn("last", last)
    return rows.withColumn("record", _before("ends", order)).select(*_RANGE, "place", "value", "record", "ends", "last")


def array_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, list[str]]:
    """The text of every record, ``value``, and the folders it is read from.

    Pieces are shuffled by byte range twice and by record once; a task has a range
    at a time and never a document.
    """
    folders = []

    def copy(df: DataFrame, name: str) -> DataFrame:
        folders.append(shared_folder(spark, name))
        files.write_table(df, folders[-1])
        return spark.read.schema(df.schema).parquet(folders[-1])

    found = copy(_in_ranges(pieces(spark, path)), "json-pieces")
    found = copy(_numbered(found, copy(_begins(found), "json-ranges")), "json-numbered")
    ends = found.groupBy(*_RANGE).agg(F.sum("ends").alias("n"))
    ends = ends.withColumn("before", _before("n", Window.partitionBy("file").orderBy("first_byte"))).drop("n")
    rows = found.join(copy(ends, "json-ends"), list(_RANGE)).withColumn("record", F.col("before") + F.col("record"))
    piece = F.struct("first_byte", "place", "value", "last")
    records = rows.groupBy("file", "record").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda x: F.concat(x["value"], F.when(x["last"], "").otherwise("}"))), "")
    text = F.regexp_replace(F.regexp_replace(text, r"\A[\s﻿]*\[?[\s,]*", ""), r"\A\]?\s*\z", "")
    return records.select(text.alias("value")).where("value <> ''"), folders


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The records of all documents, with ``_corrupt_record`` filled where one did not fit."""
    with_mark = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    records, _ = array_records(spark, path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return records.select(F.from_json("value", with_mark, options).alias("x")).select("x.*")
