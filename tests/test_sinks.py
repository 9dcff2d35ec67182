from __future__ import annotations

import datetime as dt
import os
import shutil
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import plan
from ledgerline import schemas
from ledgerline.operators import accounts, clean
from ledgerline.session import shared_folder
from ledgerline.sinks import files
from ledgerline.sinks.jdbc import jdbc_write_options

BLANK = dict.fromkeys(schemas.LOAN_COLUMNS)


def loans(spark, *ids):
    rows = [tuple({**BLANK, "Application_ID": i, "Credit_History": "1"}.values()) for i in ids]
    return spark.createDataFrame(rows, schemas.LOAN_FEED)


def test_versions_are_published_whole(spark, tmp_path):
    root = str(tmp_path / "customer")
    with pytest.raises(FileNotFoundError):
        files.read_current(spark, root)
    files.publish(spark.range(3), root)
    files.publish(spark.range(5), root)
    assert files.read_current(spark, root).count() == 5


def test_an_unfinished_version_is_not_read_and_not_reused(spark, tmp_path):
    root = str(tmp_path / "customer")
    files.publish(spark.range(3), root)
    os.makedirs(tmp_path / "customer" / "v=2")
    shutil.copy(next((tmp_path / "customer" / "v=1").glob("part-*")), tmp_path / "customer" / "v=2")
    assert files.read_current(spark, root).count() == 3
    assert files.publish(spark.range(7), root).endswith("v=3")
    assert files.read_current(spark, root).count() == 7


def test_a_failed_job_publishes_nothing(spark, tmp_path):
    root = str(tmp_path / "loan")
    files.publish(spark.range(3), root)
    with pytest.raises(Exception):
        files.publish(spark.range(100).selectExpr("raise_error('stop') AS id"), root)
    assert files.read_current(spark, root).count() == 3


def test_update_writes_a_new_version_of_the_table_it_reads(spark, tmp_path):
    root = str(tmp_path / "customer")
    files.publish(spark.createDataFrame([(1, "old"), (2, "kept")], "SSN int, CUST_EMAIL string"), root)
    requests = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "new")], "SSN int, REQUESTED_AT timestamp, CUST_EMAIL string")
    files.publish(accounts.apply_updates(files.read_current(spark, root), requests), root)
    assert {tuple(r) for r in files.read_current(spark, root).collect()} == {(1, "new"), (2, "kept")}


def test_save_modes_are_real(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(3), path)
    with pytest.raises(AnalysisException, match="already exists"):
        files.write_table(spark.range(3), path)
    files.write_table(spark.range(2), path, "overwrite")
    files.write_table(spark.range(2), path, "append")
    assert spark.read.parquet(path).count() == 4


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Two years of days, half of the rows in one month, as partitioned table."""
    path = str(tmp_path_factory.mktemp("fact") / "txn")
    days = [(2018, 1 + n % 12, 1 + n % 28) for n in range(300)] + [(2019, 3, 1 + n % 31) for n in range(300)]
    raw = spark.createDataFrame(
        [("4001", y, m, d, 9, 1, "Gas", Decimal("1.00"), n) for n, (y, m, d) in enumerate(days)], schemas.TRANSACTION
    )
    files.write_transactions(clean.clean_transaction(raw), path)
    return path


def test_fact_table_is_partitioned_by_month(spark, stored):
    assert spark.read.parquet(stored).count() == 600
    assert os.path.isdir(f"{stored}/TXN_YEAR=2019/TXN_MONTH=3")


def test_bill_reads_one_month_of_the_stored_table(spark, stored):
    bill = accounts.monthly_bill(spark.read.parquet(stored), "4001", 2019, 3)
    text = plan(bill)
    scan = text[text.index("PartitionFilters"):]
    assert "(TXN_YEAR" in scan and "(TXN_MONTH" in scan
    assert "EqualTo(CUST_CC_NO,4001)" in scan and "GreaterThanOrEqual(TXN_DATE,2019-03-01)" in scan
    assert "LessThan(TXN_DATE,2019-04-01)" in scan
    assert bill.count() == 300


def test_range_reads_only_its_years(spark, stored):
    rows = accounts.transactions_between(spark.read.parquet(stored), 9, dt.date(2018, 12, 31), dt.date(2019, 3, 2))
    assert "TXN_YEAR" in plan(rows)[plan(rows).index("PartitionFilters"):].split("]")[0]
    assert rows.count() == sum(1 for n in range(300) if 1 + n % 31 <= 2)


def test_bulk_bills_read_only_the_months_asked_for(spark, stored, tmp_path):
    """The files of another month are broken, so reading them would fail."""
    schema = spark.read.parquet(stored).schema
    shutil.copytree(stored, tmp_path / "txn")
    for file in (tmp_path / "txn" / "TXN_YEAR=2019" / "TXN_MONTH=3").glob("part-*"):
        file.write_bytes(b"no parquet")
    txn = spark.read.schema(schema).parquet(str(tmp_path / "txn"))
    requests = spark.createDataFrame([("4001", 2018, 11), ("4001", 2018, 12), ("4002", 2018, 11)], "CUST_CC_NO string, YEAR int, MONTH int")
    assert accounts.monthly_bill_bulk(txn, requests).count() == 50
    assert accounts.monthly_bill_run(txn, requests, 2018, 12).count() == 25
    with pytest.raises(Exception):
        accounts.monthly_bill_run(txn, requests, 2019, 3).count()


@pytest.mark.parametrize("lookup_by, expected", [((), 100000), (("card",), 0)])
def test_a_lookup_skips_files_without_its_key(spark, tmp_path, lookup_by, expected):
    """Rows the scan hands on when it searches a key within the file's range that no row has."""
    cards = spark.range(0, 200000, 2, 1).selectExpr("concat('4', lpad(cast(id AS string), 15, '0')) AS card")
    cards = cards.sortWithinPartitions(F.xxhash64("card"))
    files.write_table(cards, str(tmp_path / "t"), lookup_by=lookup_by)
    found = spark.read.parquet(str(tmp_path / "t")).where("card = '4000000000077777'")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found.collect() == []
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        assert scan.metrics().apply("numOutputRows").value() == expected
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_month_with_half_of_the_rows_is_written_by_several_tasks(spark, small_partitions, tmp_path):
    rows = spark.range(0, 40000, 1, 8).selectExpr(
        "concat('row ', uuid()) AS text", "CASE WHEN id % 2 = 0 THEN 3 ELSE cast(id % 12 AS int) + 20 END AS m"
    )
    files.write_table(rows, str(tmp_path / "t"), partition_by=("m",))
    assert len(list((tmp_path / "t" / "m=3").glob("part-*"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).where("m = 3").count() == 20000


def test_loan_table_checks_lengths_and_keeps_its_rows(spark, tmp_path):
    for _ in range(2):
        files.create_loan_table(spark, "loan_application_t", str(tmp_path / "loan"))
    files.append_loans(loans(spark, "LP1", "LP2"), "loan_application_t")
    files.append_loans(loans(spark, "LP2", "LP3"), "loan_application_t")
    table = spark.table("loan_application_t")
    assert sorted(r.Application_ID for r in table.collect()) == ["LP1", "LP2", "LP3"]
    assert dict(table.dtypes)["Credit_History"] == "int"
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        files.append_loans(loans(spark, "L" * 21), "loan_application_t")
    assert spark.table("loan_application_t").count() == 3
    spark.sql("DROP TABLE loan_application_t")


def test_jdbc_write_options():
    options = jdbc_write_options("jdbc:mysql://host/bank", "branch", "driver.Class", parts=4, user="u")
    assert options["dbtable"] == "branch" and options["numPartitions"] == "4"
    assert options["truncate"] == "true" and options["user"] == "u"


def test_scratch_lies_below_the_cluster_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second and first.startswith(root)
