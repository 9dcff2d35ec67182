"""Reading stored tables: Parquet folders, SQL views over them, JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: dict[str, DataFrame]) -> None:
    """Makes the frames available to ``spark.sql`` under the given names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


@dataclass(frozen=True)
class JdbcSplit:
    """How a JDBC read is spread: ranges of a numeric or date column."""

    column: str
    lower: object
    upper: object
    parts: int


def jdbc_read_options(url: str, table: str, driver: str, split: JdbcSplit, fetch_size: int = 10_000, **connection: str) -> dict[str, str]:
    """Options of a partitioned read. Bounds place the cuts, they drop no rows."""
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
        "fetchsize": str(fetch_size),
        **connection,
    }


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str, split: JdbcSplit, **connection: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, driver, split, **connection)).load()
