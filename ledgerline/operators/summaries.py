"""Monthly partial sums of the transactions, and the reports computed from them.

Counts and DECIMAL sums add up, so the sums of several loads, or of several months,
are the sum of their rows. A summary has a row for each month and key of a load, and
not one for each transaction; reports read nothing else. Undated transactions are
the month NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.functions import columns as fn
from ledgerline.operators.reports import largest_first

MONTH = ("TXN_YEAR", "TXN_MONTH")
TOTAL = T.DecimalType(38, 2)

# Each summary's keys beside the month.
BY_CUSTOMER = ("CUST_SSN",)
BY_BRANCH_AND_TYPE = ("BRANCH_CODE", "TRANSACTION_TYPE")


def schema_of(keys: tuple[str, ...]) -> T.StructType:
    kinds = {"TRANSACTION_TYPE": T.StringType()}
    fields = [T.StructField(k, kinds.get(k, T.LongType())) for k in keys]
    sums = [T.StructField("TXN_COUNT", T.LongType()), T.StructField("TOTAL_VALUE", TOTAL)]
    return T.StructType([*fields, *sums, *(T.StructField(m, T.IntegerType()) for m in MONTH)])


def summary(txn: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Count and total of every month and key of stored transactions. Sums start inside the map tasks."""
    sums = txn.groupBy(*keys, *MONTH).agg(
        F.count("*").alias("TXN_COUNT"), F.sum("TRANSACTION_VALUE").cast(TOTAL).alias("TOTAL_VALUE")
    )
    return sums.select(*schema_of(keys).names)


def merged(sums: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per month and key of several loads' summaries."""
    return sums.groupBy(*keys, *MONTH).agg(
        F.sum("TXN_COUNT").alias("TXN_COUNT"), F.sum("TOTAL_VALUE").cast(TOTAL).alias("TOTAL_VALUE")
    ).select(*schema_of(keys).names)


def _count(sums: DataFrame, *keys: str) -> DataFrame:
    return sums.groupBy(*keys).agg(F.sum("TXN_COUNT").alias("TXN_COUNT"))


def _total(sums: DataFrame, *keys: str) -> DataFrame:
    return sums.groupBy(*keys).agg(F.sum("TOTAL_VALUE").alias("TOTAL_VALUE"))


def _both(sums: DataFrame, *keys: str) -> DataFrame:
    return sums.groupBy(*keys).agg(F.sum("TXN_COUNT").alias("TXN_COUNT"), F.sum("TOTAL_VALUE").alias("TOTAL_VALUE"))


def top_customers(by_customer: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers with the highest total, labelled ``ssn ($total)``."""
    top = largest_first(_total(by_customer, "CUST_SSN"), "TOTAL_VALUE", "CUST_SSN").limit(k)
    return top.withColumn("LABEL", fn.amount_label(F.col("CUST_SSN"), F.col("TOTAL_VALUE")))


def top_months(sums: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` months with most transactions, undated rows left out."""
    dated = sums.where("TXN_YEAR is not null and TXN_MONTH is not null")
    months = _count(dated.select(F.col("TXN_YEAR").alias("YEAR"), F.col("TXN_MONTH").alias("MONTH"), "TXN_COUNT"), "YEAR", "MONTH")
    top = largest_first(months, "TXN_COUNT", "YEAR", "MONTH").limit(k)
    return top.withColumn("LABEL", fn.month_label(F.col("YEAR"), F.col("MONTH")))


def type_totals(by_branch_and_type: DataFrame) -> DataFrame:
    """Number and total value of each transaction type."""
    return _both(by_branch_and_type, "TRANSACTION_TYPE")


def txn_count_by_type(by_branch_and_type: DataFrame) -> DataFrame:
    return largest_first(_count(by_branch_and_type, "TRANSACTION_TYPE"), "TXN_COUNT", "TRANSACTION_TYPE")


def top_branches_for_type(by_branch_and_type: DataFrame, txn_type: str, k: int = 10) -> DataFrame:
    """The ``k`` branches with the highest total for one transaction type."""
    sums = _total(by_branch_and_type.where(F.col("TRANSACTION_TYPE") == txn_type), "BRANCH_CODE")
    top = largest_first(sums, "TOTAL_VALUE", "BRANCH_CODE").limit(k)
    return top.withColumn("WHOLE_VALUE", fn.whole(F.col("TOTAL_VALUE")))


def branch_state_totals(by_branch_and_type: DataFrame, branches: DataFrame) -> DataFrame:
    """Number and total value of transactions per branch state."""
    per_branch = _both(by_branch_and_type, "BRANCH_CODE")
    return _both(per_branch.join(branches.select("BRANCH_CODE", "BRANCH_STATE"), "BRANCH_CODE"), "BRANCH_STATE")
