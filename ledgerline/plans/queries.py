"""The registered queries: every operator over the mapped test tables.

Each takes ``(spark, sf_dir)`` and reads whole tables. The parameters of a
lookup, a bill or a report are the feature itself and no row cap.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerline import schemas, testviews as v
from ledgerline.functions import columns as fn
from ledgerline.operators import accounts, clean, drift, loans, quality, reports, summaries
from ledgerline.plans import etl, growing
from ledgerline.session import shared_folder, shuffles_removed
from ledgerline.sinks import files, manifest
from ledgerline.sources import json, tables

Query = Callable[[SparkSession, str], DataFrame]

SSN = 7
CARD = "4000000000000007"
TYPE = "ECONOMY"
STATE = "NATION_3"
ZIP = 1007

# A delivered loan document holds this many consecutive application numbers.
DOCUMENT_SIZE = 500


def comparable(df: DataFrame) -> DataFrame:
    """Exact decimals as DOUBLE, dates and times as text, for the side-by-side check."""

    def plain(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# --- sources and loading ----------------------------------------------------

def _as_json(df: DataFrame, name: str) -> str:
    path = shared_folder(df.sparkSession, name)
    df.write.json(path)
    return path


def scan_json_branch(spark, sf):
    path = _as_json(v.raw_branch(spark, sf), "branch-json")
    return json.read_branches(spark, path, schemas.BRANCH).drop(quality.CORRUPT)


def scan_json_customer(spark, sf):
    path = _as_json(v.raw_customer(spark, sf), "customer-json")
    return json.read_customers(spark, path, schemas.CUSTOMER).drop(quality.CORRUPT)


def scan_json_transaction(spark, sf):
    path = _as_json(v.raw_card(spark, sf), "card-json")
    return json.read_transactions(spark, path, schemas.TRANSACTION).drop(quality.CORRUPT)


def scan_json_array_loan(spark, sf):
    """All loans as array documents, one per line, and back.

    Application numbers are unique, so a document holds DOCUMENT_SIZE records at most.
    """
    loan = v.raw_loan(spark, sf)
    number = F.substring("Application_ID", 3, 12).cast("bigint")
    documents = loan.groupBy(F.floor(number / DOCUMENT_SIZE).alias("document")).agg(
        F.to_json(F.collect_list(F.struct(*loan.columns))).alias("value")
    )
    path = shared_folder(spark, "loan-json")
    documents.select("value").write.text(path)
    return json.read_loans(spark, path).drop(quality.CORRUPT)


def schema_drift_report(spark, sf):
    """Transactions delivered with a new field, a nested one and a changed type, beside the declared columns."""
    card = v.raw_card(spark, sf)
    given = {c: F.col(c) for c in card.columns}
    given["CHANNEL"] = F.when(F.col("TRANSACTION_TYPE") == "1-URGENT", "web")
    device = F.struct(F.col("TRANSACTION_ID").alias("id"), F.lit("app").alias("kind"))
    given["DEVICE"] = F.when(F.col("TRANSACTION_VALUE") >= 200000, device)
    texts = {**given, "TRANSACTION_VALUE": F.col("TRANSACTION_VALUE").cast("string")}
    as_json = lambda columns: F.to_json(F.struct(*(c.alias(name) for name, c in columns.items())))
    line = F.when(F.col("TRANSACTION_TYPE") == "5-LOW", as_json(texts)).otherwise(as_json(given))
    path = shared_folder(spark, "card-lines")
    card.select(line.alias("value")).write.text(path)
    return drift.schema_drift(spark.read.text(path), schemas.TRANSACTION)


def _flagged_feed(spark, sf):
    return quality.flag(v.loan_feed(spark, sf), quality.loan_rules())


def load_report(spark, sf):
    return quality.load_report(_flagged_feed(spark, sf), "Application_ID")


# Records of a packed file, which one task reads.
PACKED_RECORDS = 500_000


def _as_packed_json(df: DataFrame, name: str) -> str:
    """``df`` as gzipped JSON lines: a tenth of their bytes or less, as names and most values repeat."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "gzip").option("maxRecordsPerFile", PACKED_RECORDS).json(path)
    return path


def _loan_loads(spark, sf):
    """The loan table after two loads, earlier applications and then the feed: its folder, and the second report.

    A delivery is removed once it is loaded.
    """
    table, folder = f"loans_{uuid.uuid4().hex}", shared_folder(spark, "loan-table")
    files.create_loan_table(spark, table, folder)
    report = None
    for number, delivery in enumerate((v.earlier_loans(spark, sf), v.loan_feed(spark, sf))):
        with shuffles_removed(spark):
            documents = _as_packed_json(delivery, "loan-json")
        rejects = f"{shared_folder(spark, 'loan-rejects')}/{number}"
        report = etl.load_loans(spark, documents, table, rejects, most_rejected=1.0)
        files.remove(spark, documents)
    spark.sql(f"DROP TABLE {table}")  # the folder stays
    return folder, report


def loan_load(spark, sf):
    folder, _ = _loan_loads(spark, sf)
    return spark.read.parquet(folder).select(*schemas.LOAN_COLUMNS)


def loan_load_report(spark, sf):
    return _loan_loads(spark, sf)[1]


def loan_accepted(spark, sf):
    return quality.as_stored_loan(quality.accepted(_flagged_feed(spark, sf), "Application_ID"))


def loan_rejects(spark, sf):
    """The flagged feed is used three times, so it is written once."""
    return quality.rejected(etl.staged(_flagged_feed(spark, sf), "loan-feed"), "Application_ID")


def loan_duplicate_keys(spark, sf):
    return quality.duplicate_keys(v.loan_feed(spark, sf, "Application_ID"), "Application_ID")


def loan_new_only(spark, sf):
    return quality.new_only(v.raw_loan(spark, sf), v.stored_loan_keys(spark, sf), "Application_ID").select(
        *schemas.LOAN_COLUMNS
    )


def loan_already_stored(spark, sf):
    return quality.already_stored(v.raw_loan(spark, sf), v.stored_loan_keys(spark, sf), "Application_ID").select(
        *schemas.LOAN_COLUMNS
    )


def loan_full_scan(spark, sf):
    tables.register_views({"loan_application": v.loan(spark, sf)})
    return spark.table("loan_application")


def scan_json_multi_line_loan(spark, sf):
    """All loans as a few array documents that span lines, and back: each is read by many tasks."""
    loan = v.raw_loan(spark, sf)
    record = F.to_json(F.struct(*loan.columns), {"pretty": "true"})
    number = F.substring("Application_ID", 3, 30).cast("bigint")
    rows = loan.select(F.col("Property_Area").alias("document"), number.alias("number"), record.alias("record"))
    first = rows.groupBy("document").agg(F.min("number").alias("first"))
    lines = rows.join(first, "document").select(
        "document", "number", F.concat(F.when(F.col("number") == F.col("first"), "[").otherwise(","), "record").alias("value")
    )
    ends = first.select("document", F.lit(2**62).alias("number"), F.lit("]").alias("value"))
    path = shared_folder(spark, "loan-documents")
    in_order = lines.unionByName(ends).repartition("document").sortWithinPartitions("document", "number")
    in_order.select("document", "value").write.partitionBy("document").text(path)
    return json.read_loans(spark, path, multi_line=True).select(*schemas.LOAN_COLUMNS)


def _loaded_transactions(spark, sf):
    """All transactions delivered as JSON, loaded into the partitioned table, and read from it."""
    path = _as_json(v.raw_card(spark, sf), "card-json")
    root = shared_folder(spark, "bank")
    etl.load(etl.transactions(json.read_transactions(spark, path)), root)
    return files.read_current(spark, f"{root}/transaction")


def transaction_load(spark, sf):
    return _loaded_transactions(spark, sf)


# Deliveries with defects: the view that makes it, and how it is read and loaded.
_FEEDS = {
    "branch": (v.branch_feed, json.read_branches, etl.branches),
    "customer": (v.customer_feed, json.read_customers, etl.customers),
    "transaction": (v.card_feed, json.read_transactions, etl.transactions),
}
# The feeds hold far more defects than the gate lets pass by default.
_MOST_REJECTED = 0.5


def _loaded(spark, sf, name: str) -> str:
    """Delivers one feed as JSON and loads it: the root folder of its tables."""
    feed, read, delivery = _FEEDS[name]
    root = shared_folder(spark, "bank")
    etl.load(delivery(read(spark, _as_json(feed(spark, sf), f"{name}-json"))), root, _MOST_REJECTED)
    return root


def branch_load(spark, sf):
    return files.read_current(spark, f"{_loaded(spark, sf, 'branch')}/branch")


def customer_load(spark, sf):
    """One row per key, the latest; of wide and decimal keys, long ZIP codes, times in two formats."""
    return files.read_current(spark, f"{_loaded(spark, sf, 'customer')}/customer")


def customer_lookup_repeated(spark, sf):
    """Lookup of a customer that the delivery names once per order: one row."""
    return accounts.customer_lookup(customer_load(spark, sf), 3_000_000_000 + SSN)


def card_load(spark, sf):
    """Transactions without those on days that do not exist, without card, or with a third decimal."""
    return files.read_current(spark, f"{_loaded(spark, sf, 'transaction')}/transaction")


def card_load_rejects(spark, sf):
    """The rejected transactions as they were delivered."""
    rejects = files.read_current(spark, f"{_loaded(spark, sf, 'transaction')}/transaction_rejects")
    return rejects.drop(quality.CORRUPT)


def bank_load_report(spark, sf):
    """The three deliveries loaded together: rows per table and outcome."""
    paths = [_as_json(feed(spark, sf), f"{name}-json") for name, (feed, *_) in _FEEDS.items()]
    found = etl.load_bank(spark, *paths, shared_folder(spark, "bank"), _MOST_REJECTED)
    rows = [report.withColumn("table", F.lit(name)) for name, report in found.items()]
    return reduce(DataFrame.unionByName, rows)


def top_months_stored(spark, sf):
    return reports.top_months(_loaded_transactions(spark, sf))


def customer_txn_between_stored(spark, sf):
    return accounts.transactions_between(_loaded_transactions(spark, sf), SSN, dt.date(1996, 12, 1), dt.date(1999, 2, 28))


def monthly_bill_bulk_stored(spark, sf):
    return accounts.monthly_bill_bulk(_loaded_transactions(spark, sf), v.shipped_months(spark, sf))


def type_total_any_case_stored(spark, sf):
    """The stored type in small letters is compared in the scan."""
    return reports.type_total(_loaded_transactions(spark, sf), "1-Urgent", ignore_case=True)


# --- tables that grow --------------------------------------------------------

# A month that is delivered with wrong values first, and corrected.
_CORRECTED = (1996, 2)


_GROWN: dict[tuple[str, str], str] = {}


def _grown(spark, sf) -> str:
    """The root folder of order lines loaded in two deliveries that share months, one month corrected, its sums merged.

    A session grows it once; every report reads what is stored.
    """
    made = (spark.sparkContext.applicationId, sf)
    if made in _GROWN and manifest.current(spark, _GROWN[made]).number:
        return _GROWN[made]
    root = shared_folder(spark, "grown-bank")
    feed = v.txn_feed(spark, sf)
    wrong = (F.col("YEAR") == str(_CORRECTED[0])) & (F.col("MONTH") == str(_CORRECTED[1]))
    value = F.when(wrong, "1.00").otherwise(F.col("TRANSACTION_VALUE"))
    early = F.col("ordered") < F.lit("1996-01-01").cast("timestamp_ntz")
    growing.append_transactions(feed.withColumn("TRANSACTION_VALUE", value).where(early).drop("ordered"), root)
    growing.append_transactions(feed.where(~early).drop("ordered"), root)
    right = clean.as_stored_transactions(clean.clean_transaction(feed.where(wrong)))
    growing.replace_months(right, root, [_CORRECTED])
    growing.merge_summaries(spark, root)
    _GROWN[made] = root
    return root


def _sums(spark, sf, table: str):
    return growing.read_summary(spark, _grown(spark, sf), table)


def top_customers_summed(spark, sf):
    return summaries.top_customers(_sums(spark, sf, "by_customer"))


def top_months_summed(spark, sf):
    return summaries.top_months(_sums(spark, sf, "by_branch_and_type"))


def type_totals_summed(spark, sf):
    return summaries.type_totals(_sums(spark, sf, "by_branch_and_type"))


def txn_count_by_type_summed(spark, sf):
    return summaries.txn_count_by_type(_sums(spark, sf, "by_branch_and_type"))


def top_branches_for_type_summed(spark, sf):
    return summaries.top_branches_for_type(_sums(spark, sf, "by_branch_and_type"), TYPE)


def branch_state_totals_summed(spark, sf):
    branches = v.raw_branch(spark, sf, "BRANCH_CODE", "BRANCH_STATE")
    return summaries.branch_state_totals(_sums(spark, sf, "by_branch_and_type"), branches)


def type_totals_grown(spark, sf):
    """The same from the facts of all loads."""
    return reports.type_totals(growing.read_transactions(spark, _grown(spark, sf)))


def customer_email_stored(spark, sf):
    """Requests stored in two updates by key, the earlier ones first, and the table read back."""
    root = shared_folder(spark, "customers")
    customers, requests = v.customer(spark, sf), v.email_requests(spark, sf)
    growing.create_customers(customers, root)
    middle = requests.agg(F.percentile_approx("REQUESTED_AT", 0.5).alias("m")).scalar()
    growing.update_customers(requests.where(F.col("REQUESTED_AT") < middle), root, customers.schema)
    growing.update_customers(requests.where(F.col("REQUESTED_AT") >= middle), root, customers.schema)
    return growing.read_customers(spark, root, customers.schema)


# --- clean-up ---------------------------------------------------------------

def branch_clean(spark, sf):
    return v.branch(spark, sf)


def customer_clean(spark, sf):
    return v.customer(spark, sf)


def transaction_clean(spark, sf):
    return clean.clean_transaction(v.raw_card(spark, sf))


def zip_default(spark, sf):
    zip_code = fn.zip_or_unknown(F.col("CUST_ZIP"))
    return v.raw_customer(spark, sf, "SSN", "CUST_ZIP").select(
        "SSN", "CUST_ZIP", zip_code.alias("ZIP"), fn.zip_text(zip_code).alias("ZIP5")
    )


def phone_format(spark, sf):
    return v.raw_customer(spark, sf, "SSN", "CUST_PHONE").withColumn("PHONE", fn.us_phone(F.col("CUST_PHONE")))


def address_join(spark, sf):
    return v.raw_customer(spark, sf, "SSN", "APT_NO", "STREET_NAME").withColumn(
        "ADDRESS", fn.street_address(F.col("APT_NO"), F.col("STREET_NAME"))
    )


def name_case(spark, sf):
    return v.raw_customer(spark, sf, "SSN", "FIRST_NAME", "MIDDLE_NAME").withColumns(
        {"TITLE_CASE": F.initcap("FIRST_NAME"), "LOWER_CASE": F.lower("MIDDLE_NAME")}
    )


def timeid_key(spark, sf):
    date = fn.calendar_date(F.col("YEAR"), F.col("MONTH"), F.col("DAY"))
    return v.raw_card(spark, sf, "TRANSACTION_ID", "YEAR", "MONTH", "DAY").withColumns(
        {"TXN_DATE": date, "TIMEID": fn.time_id(date)}
    )


# --- accounts ---------------------------------------------------------------

def customer_email_upsert(spark, sf):
    return accounts.apply_updates(v.customer(spark, sf), v.email_requests(spark, sf))


def email_requests_unmatched(spark, sf):
    return accounts.unmatched_keys(v.raw_customer(spark, sf, "SSN"), v.part_requests(spark, sf))


def customer_lookup(spark, sf):
    return accounts.customer_lookup(v.customer(spark, sf), SSN)


def customer_lookup_bulk(spark, sf):
    """Every customer some event asks for."""
    return accounts.customer_lookup_bulk(v.customer(spark, sf), v.email_requests(spark, sf))


def lookup_unmatched_keys(spark, sf):
    """Part numbers taken as customer keys; the higher ones belong to nobody."""
    wanted = v.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("SSN"))
    return accounts.unmatched_keys(v.raw_customer(spark, sf, "SSN"), wanted)


def monthly_bill(spark, sf):
    return accounts.monthly_bill(v.card(spark, sf), CARD, 1995, 10)


def monthly_bill_run(spark, sf):
    """January 1998 for the cards of all customers with events."""
    return accounts.monthly_bill_run(v.card(spark, sf), v.event_cards(spark, sf), 1998, 1)


def monthly_bill_bulk(spark, sf):
    """Bills for every card and month in which one of its orders had a line shipped."""
    return accounts.monthly_bill_bulk(v.card(spark, sf), v.shipped_months(spark, sf))


def customer_txn_between(spark, sf):
    return accounts.transactions_between(v.card(spark, sf), SSN, dt.date(1996, 1, 1), dt.date(1999, 12, 31))


# --- reports ----------------------------------------------------------------

def txn_by_zip_month(spark, sf):
    customers = v.raw_customer(spark, sf, "SSN", "CUST_ZIP").withColumn("CUST_ZIP", fn.zip_or_unknown(F.col("CUST_ZIP")))
    return reports.txn_by_zip_month(v.card(spark, sf), customers, ZIP, 1998, 1)


def type_totals(spark, sf):
    return reports.type_totals(v.txn(spark, sf, "TRANSACTION_TYPE", "TRANSACTION_VALUE"))


def type_total_given(spark, sf):
    return reports.type_total(v.txn(spark, sf, "TRANSACTION_TYPE", "TRANSACTION_VALUE"), TYPE)


def type_total_any_case(spark, sf):
    return reports.type_total(v.txn(spark, sf, "TRANSACTION_TYPE", "TRANSACTION_VALUE"), TYPE.title(), ignore_case=True)


def branch_state_totals(spark, sf):
    branches = v.raw_branch(spark, sf, "BRANCH_CODE", "BRANCH_STATE")
    return reports.branch_state_totals(v.txn(spark, sf, "BRANCH_CODE", "TRANSACTION_VALUE"), branches)


def branch_state_total_given(spark, sf):
    branches = v.raw_branch(spark, sf, "BRANCH_CODE", "BRANCH_STATE")
    return reports.branch_state_total(v.txn(spark, sf, "BRANCH_CODE", "TRANSACTION_VALUE"), branches, STATE)


def txn_count_by_type(spark, sf):
    return reports.txn_count_by_type(v.txn(spark, sf, "TRANSACTION_TYPE"))


def txn_count_by_type_share(spark, sf):
    return reports.txn_count_by_type_share(v.txn(spark, sf, "TRANSACTION_TYPE"))


def customers_by_state(spark, sf):
    return reports.customers_by_state(v.raw_customer(spark, sf, "CUST_STATE"))


def top_customers(spark, sf):
    return reports.top_customers(v.customer_sums(spark, sf))


def top_customers_share(spark, sf):
    return reports.top_customers_share(v.customer_sums(spark, sf))


def top_months(spark, sf):
    return reports.top_months(v.txn(spark, sf, "TXN_DATE"))


def top_months_share(spark, sf):
    return reports.top_months_share(v.txn(spark, sf, "TXN_DATE"))


def top_branches_for_type(spark, sf):
    return reports.top_branches_for_type(v.txn(spark, sf, "BRANCH_CODE", "TRANSACTION_TYPE", "TRANSACTION_VALUE"), TYPE)


def leader_type(spark, sf):
    return reports.leaders(reports.counts(v.txn(spark, sf, "TRANSACTION_TYPE"), "TRANSACTION_TYPE", "TXN_COUNT"), "TXN_COUNT")


def leader_state(spark, sf):
    return reports.leaders(reports.counts(v.raw_customer(spark, sf, "CUST_STATE"), "CUST_STATE", "CUSTOMER_COUNT"), "CUSTOMER_COUNT")


def leader_customer(spark, sf):
    return reports.leaders(reports.totals(v.customer_sums(spark, sf), "CUST_SSN"), "TOTAL_VALUE")


def leader_branch(spark, sf):
    txn = v.txn(spark, sf, "BRANCH_CODE", "TRANSACTION_TYPE", "TRANSACTION_VALUE")
    return reports.leaders(reports.totals(reports.of_type(txn, TYPE), "BRANCH_CODE"), "TOTAL_VALUE")


# --- loans ------------------------------------------------------------------

def loan_status_counts(spark, sf):
    return loans.status_counts(v.loan(spark, sf, "Gender", "Married", "Self_Employed", "Application_Status"))


def approval_rate_self_employed(spark, sf):
    return loans.approval_rate_self_employed(v.loan(spark, sf, "Self_Employed", "Application_Status"))


def approval_rate_as_written(spark, sf):
    return loans.approval_rate_self_employed(v.loan(spark, sf, "Self_Employed", "Application_Status"), as_written=True)


def rejection_rate_married_male(spark, sf):
    return loans.rejection_rate_married_male(v.loan(spark, sf, "Gender", "Married", "Application_Status"))


def rejection_split_married_male(spark, sf):
    return loans.rejection_split_married_male(v.loan(spark, sf, "Gender", "Married", "Application_Status"))


def loan_segment_rates(spark, sf):
    return loans.segment_rates(v.loan(spark, sf, *loans.SEGMENTS, "Application_Status"))


def loan_segment_rollup(spark, sf):
    segments = ("Property_Area", "Education", "Self_Employed")
    return loans.segment_rates(v.loan(spark, sf, *segments, "Application_Status"), segments, "rollup")


def loan_target_segments(spark, sf):
    return loans.target_segments(v.loan(spark, sf, *loans.SEGMENTS, "Application_Status"))


def loan_frequent_segments(spark, sf):
    return loans.frequent_segments(v.loan(spark, sf, *loans.SEGMENTS, "Application_Status"))


_QUERIES = (
    scan_json_branch, scan_json_customer, scan_json_transaction, scan_json_array_loan,
    scan_json_multi_line_loan, transaction_load, branch_load, customer_load, customer_lookup_repeated,
    card_load, card_load_rejects, bank_load_report,
    load_report, loan_load, loan_load_report, loan_accepted, loan_rejects, loan_duplicate_keys,
    loan_new_only, loan_already_stored, loan_full_scan,
    branch_clean, customer_clean, transaction_clean,
    zip_default, phone_format, address_join, name_case, timeid_key,
    customer_email_upsert, email_requests_unmatched,
    customer_lookup, customer_lookup_bulk, lookup_unmatched_keys,
    monthly_bill, monthly_bill_run, monthly_bill_bulk, customer_txn_between,
    txn_by_zip_month, type_totals, type_total_given, type_total_any_case,
    branch_state_totals, branch_state_total_given,
    txn_count_by_type, txn_count_by_type_share, customers_by_state,
    top_customers, top_customers_share, top_months, top_months_share, top_branches_for_type,
    top_months_stored, customer_txn_between_stored, monthly_bill_bulk_stored, type_total_any_case_stored,
    leader_type, leader_state, leader_customer, leader_branch,
    loan_status_counts, approval_rate_self_employed, approval_rate_as_written,
    rejection_rate_married_male, rejection_split_married_male,
    loan_segment_rates, loan_segment_rollup,
    top_customers_summed, top_months_summed, type_totals_summed, txn_count_by_type_summed,
    top_branches_for_type_summed, branch_state_totals_summed, type_totals_grown, customer_email_stored,
    loan_target_segments, loan_frequent_segments, schema_drift_report,
)


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(spark, sf_dir))


QUERIES: dict[str, Query] = {query.__name__: _registered(query) for query in _QUERIES}
