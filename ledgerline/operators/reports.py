"""Reports on transactions, customers and branches.

Totals stay DECIMAL, so they do not depend on the order of summation. Every
ranking has the group's key as last sort column, so equal measures cannot swap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.functions import columns as fn
from ledgerline.operators.accounts import MONTH_COLUMNS, month_rows, newest_first
from ledgerline.operators.clean import TYPE_KEY, ignoring_case


# --- groups -----------------------------------------------------------------

def counts(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def totals(txn: DataFrame, key: str, name: str = "TOTAL_VALUE") -> DataFrame:
    return txn.groupBy(key).agg(F.sum("TRANSACTION_VALUE").alias(name))


def largest_first(groups: DataFrame, measure: str, *keys: str) -> DataFrame:
    return groups.orderBy(F.col(measure).desc(), *[F.col(k).asc() for k in keys])


def _with_percent(groups: DataFrame, measure: str) -> DataFrame:
    part, of = F.col(measure), F.col("TOTAL")
    return groups.withColumns({"PCT": fn.percent(part, of), "PCT_LABEL": fn.percent_label(part, of)})


def with_share(groups: DataFrame, measure: str) -> DataFrame:
    """Adds the sum over all groups, each group's percentage of it and a label.

    The sum is a scalar subquery on the grouped rows: its aggregation reuses the
    shuffle of the groups, and no window gathers all groups in one task.
    """
    return _with_percent(groups.withColumn("TOTAL", groups.agg(F.sum(measure)).scalar()), measure)


def with_share_of_top(top: DataFrame, measure: str) -> DataFrame:
    """The same within a top-k result, whose k rows already sit in one task."""
    return _with_percent(top.withColumn("TOTAL", F.sum(measure).over(Window.partitionBy())), measure)


def leaders(groups: DataFrame, measure: str) -> DataFrame:
    """The groups with the highest measure, all of them when tied."""
    return groups.where(F.col(measure) == groups.agg(F.max(measure).alias("m")).scalar())


# --- transactions by type ---------------------------------------------------

def of_type(txn: DataFrame, txn_type: str, ignore_case: bool = False) -> DataFrame:
    """Rows of one type. The stored type in small letters, if there, is compared in the scan."""
    if ignore_case and TYPE_KEY in txn.columns:
        return txn.where(F.col(TYPE_KEY) == txn_type.lower())
    if ignore_case:
        txn = ignoring_case(txn, "TRANSACTION_TYPE")
    return txn.where(F.col("TRANSACTION_TYPE") == txn_type)


def txn_count_by_type(txn: DataFrame) -> DataFrame:
    return largest_first(counts(txn, "TRANSACTION_TYPE", "TXN_COUNT"), "TXN_COUNT", "TRANSACTION_TYPE")


def txn_count_by_type_share(txn: DataFrame) -> DataFrame:
    """Counts with their share of all transactions, labelled ``16.7% (1234)``."""
    shared = with_share(counts(txn, "TRANSACTION_TYPE", "TXN_COUNT"), "TXN_COUNT")
    label = F.concat("PCT_LABEL", F.lit(" ("), F.col("TXN_COUNT").cast("string"), F.lit(")"))
    return largest_first(shared.withColumn("PCT_LABEL", label), "TXN_COUNT", "TRANSACTION_TYPE")


def type_totals(txn: DataFrame) -> DataFrame:
    """Number and total value of each transaction type."""
    return txn.groupBy("TRANSACTION_TYPE").agg(
        F.count("*").alias("TXN_COUNT"), F.sum("TRANSACTION_VALUE").alias("TOTAL_VALUE")
    )


def type_total(txn: DataFrame, txn_type: str, ignore_case: bool = False) -> DataFrame:
    """Number and total value of one transaction type, as one row."""
    return of_type(txn, txn_type, ignore_case).agg(
        F.count("*").alias("TXN_COUNT"), F.sum("TRANSACTION_VALUE").alias("TOTAL_VALUE")
    )


# --- customers --------------------------------------------------------------

def customers_by_state(customers: DataFrame) -> DataFrame:
    return largest_first(counts(customers, "CUST_STATE", "CUSTOMER_COUNT"), "CUSTOMER_COUNT", "CUST_STATE")


def top_customers(txn: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` customers with the highest total, labelled ``ssn ($total)``."""
    top = largest_first(totals(txn, "CUST_SSN"), "TOTAL_VALUE", "CUST_SSN").limit(k)
    return top.withColumn("LABEL", fn.amount_label(F.col("CUST_SSN"), F.col("TOTAL_VALUE")))


def top_customers_share(txn: DataFrame, k: int = 10) -> DataFrame:
    """The same customers with each one's share of what they total together."""
    return with_share_of_top(top_customers(txn, k), "TOTAL_VALUE")


def txn_by_zip_month(txn: DataFrame, customers: DataFrame, zip_code: int, year: int, month: int) -> DataFrame:
    """A month's transactions of the customers in a ZIP code, newest first.

    Both filters run before the join. Its sides are a month and a ZIP code, so
    the join strategy is left to the sizes Spark sees at run time.
    """
    local = customers.where(F.col("CUST_ZIP") == zip_code).select("SSN", "CUST_ZIP")
    rows = month_rows(txn, year, month)
    joined = rows.join(local, rows["CUST_SSN"] == local["SSN"]).drop("SSN")
    return newest_first(joined)


# --- months -----------------------------------------------------------------

def top_months(txn: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` months with most transactions; undated rows are left out first.

    A table partitioned by month is counted by its partition columns, of which
    the undated partition is left out: no data column is read.
    """
    if MONTH_COLUMNS <= set(txn.columns):
        dated, year, month = txn.where("TXN_YEAR is not null and TXN_MONTH is not null"), F.col("TXN_YEAR"), F.col("TXN_MONTH")
    else:
        dated, year, month = txn.where(F.col("TXN_DATE").isNotNull()), F.year("TXN_DATE"), F.month("TXN_DATE")
    months = dated.groupBy(year.alias("YEAR"), month.alias("MONTH")).agg(F.count("*").alias("TXN_COUNT"))
    top = largest_first(months, "TXN_COUNT", "YEAR", "MONTH").limit(k)
    return top.withColumn("LABEL", fn.month_label(F.col("YEAR"), F.col("MONTH")))


def top_months_share(txn: DataFrame, k: int = 3) -> DataFrame:
    return with_share_of_top(top_months(txn, k), "TXN_COUNT")


# --- branches ---------------------------------------------------------------

def top_branches_for_type(txn: DataFrame, txn_type: str, k: int = 10, ignore_case: bool = False) -> DataFrame:
    """The ``k`` branches with the highest total for one transaction type."""
    sums = totals(of_type(txn, txn_type, ignore_case), "BRANCH_CODE")
    top = largest_first(sums, "TOTAL_VALUE", "BRANCH_CODE").limit(k)
    return top.withColumn("WHOLE_VALUE", fn.whole(F.col("TOTAL_VALUE")))


def branch_state_totals(txn: DataFrame, branches: DataFrame) -> DataFrame:
    """Number and total value of transactions per branch state.

    Transactions are summed per branch before the join, so the shuffle and the
    join see one row per branch and not the fact table.
    """
    per_branch = txn.groupBy("BRANCH_CODE").agg(
        F.count("*").alias("n"), F.sum("TRANSACTION_VALUE").alias("v")
    )
    return (
        per_branch.join(branches.select("BRANCH_CODE", "BRANCH_STATE"), "BRANCH_CODE")
        .groupBy("BRANCH_STATE")
        .agg(F.sum("n").alias("TXN_COUNT"), F.sum("v").alias("TOTAL_VALUE"))
    )


def branch_state_total(txn: DataFrame, branches: DataFrame, state: str) -> DataFrame:
    return branch_state_totals(txn, branches.where(F.col("BRANCH_STATE") == state))
