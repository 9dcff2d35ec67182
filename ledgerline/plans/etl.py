"""Deliveries to stored tables: read, validate, clean, publish. One session, no row on the driver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.functions import columns as fn
from ledgerline.operators import clean, quality
from ledgerline.session import shared_folder, shuffles_removed
from ledgerline.sinks import files
from ledgerline.sources import json

# The largest share of a delivery that may be rejected.
MOST_REJECTED = 0.1
# The delivered key as a number, so that "7" and "7.0" are one key.
KEY = "_key"


@dataclass(frozen=True)
class Delivery:
    """``key``, if given, names the column of which each value is kept once, the latest record."""

    name: str
    raw: DataFrame
    rules: list[quality.Rule]
    clean: Callable[[DataFrame], DataFrame]
    partition_by: tuple[str, ...] = ()
    lookup_by: tuple[str, ...] = ()
    key: str | None = None


def branches(raw: DataFrame) -> Delivery:
    return Delivery("branch", raw, quality.branch_rules(), clean.clean_branch, key="BRANCH_CODE")


def customers(raw: DataFrame) -> Delivery:
    return Delivery(
        "customer", raw, quality.customer_rules(), clean.clean_customer, lookup_by=files.CUSTOMER_KEYS, key="SSN"
    )


def transactions(raw: DataFrame) -> Delivery:
    return Delivery(
        "transaction",
        raw,
        quality.transaction_rules(),
        lambda df: clean.as_stored_transactions(clean.clean_transaction(df)),
        ("TXN_YEAR", "TXN_MONTH"),
        files.TRANSACTION_KEYS,
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes the frame to the shared folder and reads it back; the copy stays."""
    return _copy(df, name)[0]


def _copy(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame written to the shared folder, and where; removed after its last reader.

    A delivery is parsed once and not again for every output made from it.
    """
    path = shared_folder(df.sparkSession, f"staged-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _kept(report: DataFrame) -> DataFrame:
    """The report as rows of its own, a line per outcome, when what it counted is removed."""
    return report.sparkSession.createDataFrame(report.collect(), "outcome string, rows bigint")


@dataclass(frozen=True)
class Checked:
    """A delivery that passed its gate, staged, with its report."""

    delivery: Delivery
    flagged: DataFrame
    path: str
    report: DataFrame

    @property
    def _one(self) -> tuple[str | None, Column | None]:
        return (KEY, F.col("LAST_UPDATED").try_cast("timestamp")) if self.delivery.key else (None, None)

    def publish(self, root: str) -> None:
        rejects = quality.rejected(self.flagged, *self._one)
        files.publish(rejects.drop(KEY), f"{root}/{self.delivery.name}_rejects")
        table = self.delivery.clean(quality.accepted(self.flagged, *self._one))
        files.publish(table, f"{root}/{self.delivery.name}", self.delivery.partition_by, self.delivery.lookup_by)


def check(delivery: Delivery, most_rejected: float = MOST_REJECTED) -> Checked:
    """Stages the delivery and counts it; raises when too much of it, or all, is rejected."""
    flagged = quality.flag(delivery.raw, delivery.rules)
    if delivery.key:
        flagged = flagged.withColumn(KEY, fn.whole_number(F.col(delivery.key)))
    flagged, path = _copy(flagged, delivery.name)
    try:
        quality.check_lines(flagged)
        report = _kept(quality.load_report(flagged, KEY if delivery.key else None))
        quality.check_reject_rate(report, most_rejected)
    except ValueError as error:
        files.remove(flagged.sparkSession, path)
        raise ValueError(f"{delivery.name}: {error}") from error
    return Checked(delivery, flagged, path, report)


def load(delivery: Delivery, root: str, most_rejected: float = MOST_REJECTED) -> DataFrame:
    """Publishes the clean table and its rejects below ``root``; returns the load report.

    Nothing is published when nothing was accepted or too large a share of the
    rows is rejected.
    """
    return load_all([delivery], root, most_rejected)[delivery.name]


def load_all(deliveries: list[Delivery], root: str, most_rejected: float = MOST_REJECTED) -> dict[str, DataFrame]:
    """Checks every delivery before any is published; returns a load report for each."""
    checked: list[Checked] = []
    try:
        for delivery in deliveries:
            checked.append(check(delivery, most_rejected))
        for one in checked:
            one.publish(root)
    finally:
        for one in checked:
            files.remove(one.flagged.sparkSession, one.path)
    return {one.delivery.name: one.report for one in checked}


def load_bank(
    spark: SparkSession,
    branch_path: str,
    customer_path: str,
    transaction_path: str,
    root: str,
    most_rejected: float = MOST_REJECTED,
) -> dict[str, DataFrame]:
    """Loads the three card deliveries; returns a load report for each."""
    deliveries = [
        branches(json.read_branches(spark, branch_path)),
        customers(json.read_customers(spark, customer_path)),
        transactions(json.read_transactions(spark, transaction_path)),
    ]
    return load_all(deliveries, root, most_rejected)


def load_loans(
    spark: SparkSession,
    documents: str,
    table: str,
    rejects: str,
    most_rejected: float = MOST_REJECTED,
    multi_line: bool = False,
) -> DataFrame:
    """Adds landed loan documents to the loan table; returns the load report.

    Loans the table holds already are not added; they go to the published
    ``rejects`` like the other rows left out. Nothing is added when too large a
    share of the delivery itself is rejected.
    """
    key = files.LOAN_KEY
    copies: list[str] = []

    def copy(df: DataFrame, name: str) -> DataFrame:
        frame, path = _copy(df, name)
        copies.append(path)
        return frame

    with shuffles_removed(spark):
        try:
            flagged = copy(quality.flag(json.read_loans(spark, documents, multi_line), quality.loan_rules()), "loan")
            quality.check_lines(flagged)
            report = _kept(quality.load_report(flagged, key))
            quality.check_reject_rate(report, most_rejected)
            loans = copy(quality.accepted(flagged, key), "loan-accepted")
            named = loans.count()  # from the files' footers
            # Written now: after the insertion every loan of the delivery is in the table.
            known = copy(quality.already_stored(loans, spark.table(table), key, named), "loan-known")
            left_out = known.withColumns({quality.REASON: F.lit(quality.STORED), "copies": F.lit(1).cast("bigint")})
            rejects_now = quality.rejected(flagged, key, kept=loans)
            files.publish(rejects_now.unionByName(left_out, allowMissingColumns=True), rejects)
            files.insert_loans(quality.new_only(loans, known, key, named), table)
            found = known.agg(F.count("*").alias("n")).select(
                F.stack(F.lit(2), F.lit(quality.STORED), F.col("n"), F.lit("accepted"), -F.col("n")).alias("outcome", "rows")
            )
            counted = report.unionByName(found).groupBy("outcome").agg(F.sum("rows").alias("rows"))
            return _kept(counted.where("rows > 0 or outcome in ('read', 'accepted')"))
        finally:
            for path in copies:
                files.remove(spark, path)
