"""Account questions: lookup, monthly bill, date range, contact update.

Each has a single-key form and, where one job should answer many requests, a
bulk form that takes the requests as a frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions import columns as fn
from ledgerline.operators.keyed import distinct_keys
from ledgerline.operators.quality import held_keys


# Partition columns of the stored fact table, see ``operators.clean``.
MONTH_COLUMNS = {"TXN_YEAR", "TXN_MONTH"}
# So many months are named one by one; a wider choice reads the span of them.
MONTHS_NAMED = 1200


def newest_first(txn: DataFrame) -> DataFrame:
    """By date descending, then by id; the id also lets the sort split a busy day."""
    return txn.orderBy(F.col("TXN_DATE").desc(), F.col("TRANSACTION_ID").asc())


def customer_lookup(customers: DataFrame, ssn: int) -> DataFrame:
    return customers.where(F.col("SSN") == ssn)


def customer_lookup_bulk(customers: DataFrame, wanted: DataFrame) -> DataFrame:
    """Customers named in ``wanted(SSN)``, which may repeat keys."""
    return customers.join(distinct_keys(wanted, "SSN"), "SSN", "left_semi")


def unmatched_keys(customers: DataFrame, wanted: DataFrame) -> DataFrame:
    """The keys of ``wanted(SSN)`` that belong to no customer, each once."""
    return distinct_keys(wanted, "SSN").join(held_keys(wanted, customers, "SSN"), "SSN", "left_anti")


def month_rows(txn: DataFrame, year: int, month: int) -> DataFrame:
    rows = txn.where(fn.in_month(F.col("TXN_DATE"), year, month))
    if MONTH_COLUMNS <= set(txn.columns):
        rows = rows.where((F.col("TXN_YEAR") == year) & (F.col("TXN_MONTH") == month))
    return rows


def monthly_bill(txn: DataFrame, card: str, year: int, month: int) -> DataFrame:
    """One card's transactions of a month, newest first.

    On a table partitioned by month only that month's files are read.
    """
    return newest_first(month_rows(txn, year, month).where(F.col("CUST_CC_NO") == card))


def by_card(bills: DataFrame) -> DataFrame:
    """Card after card, each card's rows newest first."""
    return bills.orderBy("CUST_CC_NO", F.col("TXN_DATE").desc(), F.col("TRANSACTION_ID").asc())


def monthly_bill_run(txn: DataFrame, cards: DataFrame, year: int, month: int) -> DataFrame:
    """One month's bills for ``cards(CUST_CC_NO)``, which may repeat, card after card."""
    bills = month_rows(txn, year, month).join(distinct_keys(cards, "CUST_CC_NO"), "CUST_CC_NO", "left_semi")
    return by_card(bills.select(*txn.columns))


def monthly_bill_bulk(txn: DataFrame, requests: DataFrame) -> DataFrame:
    """Bills for ``requests(CUST_CC_NO, YEAR, MONTH)``, which may repeat, card after card.

    Requests are deduplicated before the join; a card with very many rows in
    one month is split by adaptive execution, as the fact is the outer side. Of
    a table partitioned by month only the months asked for are read.
    """
    wanted = distinct_keys(requests, "CUST_CC_NO", "YEAR", "MONTH").withColumnRenamed("CUST_CC_NO", "_card")
    year, month = F.year("TXN_DATE"), F.month("TXN_DATE")
    rows = txn
    if MONTH_COLUMNS <= set(txn.columns):
        year, month = F.col("TXN_YEAR"), F.col("TXN_MONTH")
        asked = requests.select((F.col("YEAR") * 12 + F.col("MONTH")).alias("m")).distinct()
        months = [row.m for row in asked.where("m is not null").limit(MONTHS_NAMED + 1).collect()]
        if len(months) <= MONTHS_NAMED:
            rows = txn.where((year * 12 + month).isin(months))
        else:
            rows = txn.where((year * 12 + month).between(asked.agg(F.min("m")).scalar(), asked.agg(F.max("m")).scalar()))
    same = (F.col("CUST_CC_NO") == F.col("_card")) & (year == F.col("YEAR")) & (month == F.col("MONTH"))
    return by_card(rows.join(wanted, same, "left_semi"))


def transactions_between(txn: DataFrame, ssn: int, first: dt.date, last: dt.date) -> DataFrame:
    """A customer's transactions from ``first`` to ``last``, both included."""
    rows = txn.where((F.col("CUST_SSN") == ssn) & F.col("TXN_DATE").between(F.lit(first), F.lit(last)))
    if MONTH_COLUMNS <= set(txn.columns):
        number = F.col("TXN_YEAR") * 12 + F.col("TXN_MONTH")
        rows = rows.where(number.between(first.year * 12 + first.month, last.year * 12 + last.month))
    return newest_first(rows)


def apply_updates(customers: DataFrame, requests: DataFrame, columns: tuple[str, ...] = ("CUST_EMAIL",)) -> DataFrame:
    """All customers, with the requested new values where there are any.

    ``requests`` holds SSN, REQUESTED_AT and the columns to change. Each column
    takes its last value that is not NULL; the maximum is found inside the map
    tasks first, so a customer with very many requests weighs on no task. Write
    the result to a new place, see ``sinks.files.publish``.
    """
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct("REQUESTED_AT", c)))[c].alias(f"_new_{c}") for c in columns]
    return customers.join(requests.groupBy("SSN").agg(*last), "SSN", "left").select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in customers.columns]
    )
