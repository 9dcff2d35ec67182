"""JSON scans with fixed schemas.

Deliveries are read as text by default and typed after validation. With a typed
schema a value that does not fit becomes NULL and marks its record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerline import schemas
from ledgerline.operators.quality import CORRUPT
from ledgerline.sources.json_arrays import read_json_arrays


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON records, with ``_corrupt_record`` filled where one did not fit.

    By default a line holds a record or a whole array of records; such files
    split over many tasks. ``multi_line`` is for documents of any shape that span
    lines: one task reads one file. For arrays of objects see ``json_arrays``.
    """
    with_mark = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        spark.read.schema(with_mark)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .json(path)
    )


def read_branches(spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.BRANCH_FEED) -> DataFrame:
    return read_json(spark, path, schema)


def read_customers(spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.CUSTOMER_FEED) -> DataFrame:
    return read_json(spark, path, schema)


def read_transactions(spark: SparkSession, path: str | list[str], schema: T.StructType = schemas.TRANSACTION_FEED) -> DataFrame:
    return read_json(spark, path, schema)


def read_loans(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Landed loan documents, each a JSON array; all fields as text.

    An array that spans lines needs ``multi_line``; it is read by many tasks. Read
    without it, its lines are damaged records, which ``quality.check_lines`` refuses.
    """
    if multi_line:
        return read_json_arrays(spark, path, schemas.LOAN_FEED)
    return read_json(spark, path, schemas.LOAN_FEED)
