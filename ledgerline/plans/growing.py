"""Bank tables that grow: transactions by loads, with their monthly summaries, and customers updated by key.

All tables of a bank lie below one root and are named by its list, see
``sinks.manifest``: a load and its sums, or the changed buckets of the customers,
become visible together.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerline.operators import accounts, clean, summaries
from ledgerline.operators.quality import accepted
from ledgerline.operators.summaries import MONTH
from ledgerline.plans import etl
from ledgerline.sinks import files, manifest
from ledgerline.sinks.manifest import Listing, Part

FACTS = "transaction"
CUSTOMERS = "customer"
# Each summary's table and keys.
SUMMARIES = {"by_customer": summaries.BY_CUSTOMER, "by_branch_and_type": summaries.BY_BRANCH_AND_TYPE}

BUCKET = "SSN_BUCKET"
BUCKETS = 64  # of the customer table: a request rewrites one of so many parts of it

_EMPTY_FEED = "CREDIT_CARD_NO string, YEAR int, MONTH int, DAY int, CUST_SSN bigint, BRANCH_CODE bigint, TRANSACTION_TYPE string, TRANSACTION_VALUE decimal(18,2), TRANSACTION_ID bigint"


# --- transactions -----------------------------------------------------------

def fact_schema(spark: SparkSession) -> T.StructType:
    return clean.as_stored_transactions(clean.clean_transaction(spark.createDataFrame([], _EMPTY_FEED))).schema


def _written(facts: DataFrame, root: str) -> dict[str, Part]:
    """Writes transactions and, from what was written, their sums."""
    spark = facts.sparkSession
    parts = {FACTS: manifest.write_part(facts, root, FACTS, MONTH, files.TRANSACTION_KEYS)}
    own = manifest.read_parts(spark, root, [parts[FACTS]], facts.schema)
    for table, keys in SUMMARIES.items():
        parts[table] = manifest.write_part(summaries.summary(own, keys), root, table, MONTH)
    return parts


def append_transactions(raw: DataFrame, root: str, most_rejected: float = etl.MOST_REJECTED) -> DataFrame:
    """Adds a delivery's sound transactions and their sums; returns the load report.

    Loads add up, so one that finds another committed goes on from that one's list.
    """
    checked = etl.check(etl.transactions(raw), most_rejected)
    try:
        parts = _written(checked.delivery.clean(accepted(checked.flagged)), root)
    finally:
        files.remove(raw.sparkSession, checked.path)

    def add(now: Listing) -> Listing:
        return now.with_parts(**{table: [*now.tables.get(table, []), part] for table, part in parts.items()})

    manifest.change(raw.sparkSession, root, add)
    return checked.report


def replace_months(corrected: DataFrame, root: str, months: Iterable[tuple[int, int]]) -> None:
    """Puts ``corrected``, stored transactions, in the place of all of the given months' and sums these months anew.

    The other months' files stay as they are. ``corrected`` rows of other months are left out.
    """
    spark = corrected.sparkSession
    gone = tuple(tuple(zip(MONTH, month)) for month in sorted(set(months)))
    own = Part("", gone).kept()
    parts = _written(corrected.where(~own), root)

    def put(now: Listing) -> Listing:
        new = {}
        for table, part in parts.items():
            old = [Part(p.folder, tuple(sorted({*p.without, *gone}))) for p in now.tables.get(table, [])]
            new[table] = [*old, part]
        return now.with_parts(**new)

    manifest.change(spark, root, put)


def merge_summaries(spark: SparkSession, root: str) -> None:
    """Puts one part in the place of each summary's parts, so that reports read a row per month and key."""
    base = manifest.current(spark, root)
    merged = {}
    for table, keys in SUMMARIES.items():
        sums = manifest.read_parts(spark, root, base.tables.get(table, []), summaries.schema_of(keys))
        merged[table] = [manifest.write_part(summaries.merged(sums, keys), root, table, MONTH)]
    # Loads that came in between are not in the sums: the merge gives way to them.
    manifest.commit(spark, root, base.with_parts(**merged))


def read_transactions(spark: SparkSession, root: str) -> DataFrame:
    return manifest.read_listed(spark, root, FACTS, fact_schema(spark))


def read_summary(spark: SparkSession, root: str, table: str) -> DataFrame:
    return manifest.read_listed(spark, root, table, summaries.schema_of(SUMMARIES[table]))


# --- customers --------------------------------------------------------------

def bucket(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def create_customers(customers: DataFrame, root: str, buckets: int = BUCKETS) -> None:
    """Stores the customers, one per SSN, by buckets of the key's hash, in place of those stored before."""
    part = manifest.write_part(customers.withColumn(BUCKET, bucket(F.col("SSN"), buckets)), root, CUSTOMERS, (BUCKET,), files.CUSTOMER_KEYS)
    manifest.change(customers.sparkSession, root, lambda now: now.with_parts(**{CUSTOMERS: [part]}))


def read_customers(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The stored customers; ``schema`` is that of the frame they were created from."""
    stored = manifest.read_listed(spark, root, CUSTOMERS, _with_bucket(schema))
    return stored.drop(BUCKET)


def find_customer(spark: SparkSession, root: str, schema: T.StructType, ssn: int, buckets: int = BUCKETS) -> DataFrame:
    """One customer; only the files of the key's bucket are read."""
    stored = manifest.read_listed(spark, root, CUSTOMERS, _with_bucket(schema))
    return stored.where((F.col(BUCKET) == bucket(F.lit(ssn).cast("bigint"), buckets)) & (F.col("SSN") == ssn)).drop(BUCKET)


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


def update_customers(
    requests: DataFrame, root: str, schema: T.StructType, columns: tuple[str, ...] = ("CUST_EMAIL",), buckets: int = BUCKETS
) -> int:
    """Stores the requested changes; returns how many buckets were rewritten.

    Only the buckets that a request names are read and written; the others keep
    their files. What comes to the driver are bucket numbers. Requests for unknown
    customers change nothing. Made anew when another writer was first.
    """
    spark = requests.sparkSession
    # Requests are read several times, and a retry must see the same ones.
    requests = etl.staged(requests, "requests").withColumn(BUCKET, bucket(F.col("SSN"), buckets))
    named = sorted(r[0] for r in requests.where("SSN is not null").select(BUCKET).distinct().collect())
    if not named:
        return 0
    gone = tuple(((BUCKET, number),) for number in named)

    def put(now: Listing) -> Listing:
        old = now.tables.get(CUSTOMERS, [])
        stored = manifest.read_parts(spark, root, old, _with_bucket(schema)).where(F.col(BUCKET).isin(named))
        changed = accounts.apply_updates(stored, requests.drop(BUCKET), columns)
        part = manifest.write_part(changed, root, CUSTOMERS, (BUCKET,), files.CUSTOMER_KEYS)
        kept = [Part(p.folder, tuple(sorted({*p.without, *gone}))) for p in old]
        return now.with_parts(**{CUSTOMERS: [*kept, part]})

    manifest.change(spark, root, put)
    return len(named)
