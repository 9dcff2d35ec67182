"""Writing tables: partitioned Parquet, all-or-nothing versions, the loan table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerline import schemas
from ledgerline.operators.clean import as_stored_transactions
from ledgerline.operators.quality import as_stored_loan, new_only

# Marker Spark leaves in a folder once the whole write job is committed.
DONE = "_SUCCESS"


# Columns of the stored tables that are looked up by equality.
TRANSACTION_KEYS = ("CUST_CC_NO", "CUST_SSN")
CUSTOMER_KEYS = ("SSN",)
LOAN_KEY = "Application_ID"

# Finished versions of a published table that stay, the current one among them.
VERSIONS_KEPT = 3


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: tuple[str, ...] = (),
    lookup_by: tuple[str, ...] = (),
) -> None:
    """Parquet folder, partitioned if asked.

    Rows of one partition value are brought together to keep files few; the
    rebalance lets adaptive execution split a value that holds too many rows.
    ``lookup_by`` columns get bloom filters, so that a search for one key skips
    the parts of the files that do not hold it.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).partitionBy(*partition_by)
    if lookup_by:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in lookup_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(path)


def write_transactions(txn: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The fact table, partitioned by year and month for the month filters."""
    write_table(as_stored_transactions(txn), path, mode, ("TXN_YEAR", "TXN_MONTH"), TRANSACTION_KEYS)


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """(number, finished) of the version folders below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v="):
            marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), DONE)
            found.append((int(name[2:]), bool(fs.exists(marker))))
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, with all in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def publish(
    df: DataFrame,
    root: str,
    partition_by: tuple[str, ...] = (),
    lookup_by: tuple[str, ...] = (),
    keep: int = VERSIONS_KEPT,
) -> str:
    """Writes the next version of a table; readers see it whole or not at all.

    A version counts once Spark has committed its write job. A failed job leaves
    a folder without marker, which nobody reads. ``df`` may read the current
    version, as that is not touched. Of the finished versions the last ``keep``
    stay, so a reader has that many publications of time. One writer per table
    at a time.
    """
    spark = df.sparkSession
    versions = _versions(spark, root)
    path = f"{root}/v={versions[-1][0] + 1 if versions else 1}"
    write_table(df, path, "errorifexists", partition_by, lookup_by)
    finished = [number for number, done in _versions(spark, root) if done]
    for number in finished[: -max(1, keep)]:
        remove(spark, f"{root}/v={number}")
    return path


def current_path(spark: SparkSession, root: str) -> str | None:
    finished = [number for number, done in _versions(spark, root) if done]
    return f"{root}/v={finished[-1]}" if finished else None


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest finished version of a published table.

    Give the ``schema`` of a table that may be empty: such a version may hold no
    file to read it from.
    """
    path = current_path(spark, root)
    if path is None:
        raise FileNotFoundError(f"no finished version below {root}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def create_loan_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The stored loan table, unless it exists. Spark checks the text lengths on write.

    Its files carry bloom filters on the key, by which every load looks them up.
    """
    place = f" LOCATION '{location}'" if location else ""
    options = f"'parquet.bloom.filter.enabled#{LOAN_KEY}' 'true', 'parquet.bloom.filter.adaptive.enabled' 'true'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schemas.loan_ddl_columns()}) USING parquet OPTIONS ({options}){place}")


def append_loans(batch: DataFrame, name: str) -> None:
    """Adds accepted loans whose key the table does not hold yet, in one write job.

    Spark enforces no primary key: two loads at the same time are not guarded.
    """
    insert_loans(new_only(batch, batch.sparkSession.table(name), LOAN_KEY), name)


def insert_loans(new: DataFrame, name: str) -> None:
    """Adds loans known to be new."""
    as_stored_loan(new).write.insertInto(name)
