"""JDBC export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F


def jdbc_write_options(url: str, table: str, driver: str, parts: int = 16, batch_size: int = 10_000, **connection: str) -> dict[str, str]:
    """``parts`` bounds the connections opened at once; overwriting keeps the table's definition."""
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "numPartitions": str(parts),
        "batchsize": str(batch_size),
        "truncate": "true",
        **connection,
    }


def write_jdbc(df: DataFrame, url: str, table: str, driver: str, mode: str = "errorifexists", **connection: str) -> int:
    """Writes the frame and returns the number of rows sent.

    ``mode`` is a real save mode: ``errorifexists``, ``overwrite`` or ``append``.
    Overwriting empties the table first, so an export that fails leaves it empty
    or in part: overwrite a side table and swap the names in the database.
    A partition is one transaction, but a task that is lost after its commit runs
    again; compare the returned number with the table's count, or give the table
    a primary key, before the export is used.
    """
    sent = Observation("jdbc_export")
    (
        df.observe(sent, F.count(F.lit(1)).alias("rows"))
        .write.format("jdbc")
        .options(**jdbc_write_options(url, table, driver, **connection))
        .mode(mode)
        .save()
    )
    return sent.get["rows"]
