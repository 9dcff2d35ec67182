from __future__ import annotations

import datetime as dt
import json
import re
import time
from pathlib import Path

import pytest
from conftest import plan
from pyspark.sql import functions as F

from ledgerline.operators import accounts, reports
from ledgerline.plans import etl
from ledgerline.sinks import files
from ledgerline.sources import json as source


def write(path, records):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    return str(path)


STAMP = "2021-03-02T08:15:30.000-04:00"


def transactions(**first):
    """Ten on days that exist; ``first`` changes the first one."""
    rows = [
        {"TRANSACTION_ID": n, "CREDIT_CARD_NO": "4", "YEAR": 2018, "MONTH": 1 + n % 2, "DAY": 28, "CUST_SSN": 1, "BRANCH_CODE": 1,
         "TRANSACTION_TYPE": "Gas", "TRANSACTION_VALUE": 1.5} for n in range(10)
    ]
    rows[0].update(first)
    return rows


@pytest.fixture
def deliveries(tmp_path):
    return (
        write(tmp_path / "b.json", [{"BRANCH_CODE": 1, "BRANCH_ZIP": 4207, "BRANCH_PHONE": "9034417758", "LAST_UPDATED": STAMP}, {"BRANCH_NAME": "?"}]),
        write(tmp_path / "c.json", [{"SSN": 1, "FIRST_NAME": "ANN", "LAST_UPDATED": STAMP}, {"SSN": "x"}, "{broken"]),
        write(tmp_path / "t.json", transactions()),
    )


def outcomes(report):
    return {r.outcome: r.rows for r in report.collect()}


def test_card_deliveries_become_tables(spark, tmp_path, deliveries):
    root = str(tmp_path / "bank")
    reports = {name: outcomes(r) for name, r in etl.load_bank(spark, *deliveries, root, most_rejected=0.7).items()}
    assert reports["branch"] == {"read": 2, "accepted": 1, "missing:BRANCH_CODE": 1}
    assert reports["customer"] == {"read": 3, "accepted": 1, "corrupt_record": 1, "not_whole:SSN": 1}
    assert reports["transaction"] == {"read": 10, "accepted": 10}
    assert files.read_current(spark, f"{root}/branch").first().BRANCH_PHONE == "(903)441-7758"
    assert files.read_current(spark, f"{root}/customer").first().FIRST_NAME == "Ann"
    assert files.read_current(spark, f"{root}/customer_rejects").count() == 2
    txn = files.read_current(spark, f"{root}/transaction")
    assert txn.where("TXN_MONTH = 1").count() == 5


def test_reports_run_on_the_stored_tables(spark, tmp_path, deliveries):
    root = str(tmp_path / "bank")
    etl.load_bank(spark, *deliveries, root, most_rejected=0.7)
    txn, branches = (files.read_current(spark, f"{root}/{name}") for name in ("transaction", "branch"))
    assert reports.top_customers(txn).first().LABEL == "1 ($15.00)"
    assert [r.TXN_COUNT for r in reports.top_months(txn).collect()] == [5, 5]
    assert accounts.monthly_bill(txn, "4", 2018, 1).count() == 5
    assert reports.branch_state_totals(txn, branches).first().TXN_COUNT == 10


@pytest.mark.parametrize(
    "defect, reason",
    [
        ({"DAY": 30, "MONTH": 2}, "no_date:YEAR-MONTH-DAY"),
        ({"YEAR": None}, "no_date:YEAR-MONTH-DAY"),
        ({"CREDIT_CARD_NO": None}, "missing:CREDIT_CARD_NO"),
        ({"CUST_SSN": None}, "missing:CUST_SSN"),
        ({"CUST_SSN": "x1"}, "not_whole:CUST_SSN"),
        ({"TRANSACTION_VALUE": None}, "missing:TRANSACTION_VALUE"),
        ({"TRANSACTION_VALUE": 10.129}, "not_money:TRANSACTION_VALUE"),
    ],
)
def test_defects_are_rejected_as_delivered(spark, tmp_path, defect, reason):
    root = str(tmp_path / "bank")
    path = write(tmp_path / "t.json", transactions(**defect))
    report = outcomes(etl.load(etl.transactions(source.read_transactions(spark, path)), root))
    assert report == {"read": 10, "accepted": 9, reason: 1}
    rejected = files.read_current(spark, f"{root}/transaction_rejects").first()
    for name, value in defect.items():
        assert rejected[name] == (None if value is None else str(value))


def test_no_accepted_row_has_a_null_key(spark, tmp_path):
    root = str(tmp_path / "bank")
    customers = [{"SSN": s, "CUST_ZIP": z} for s, z in ((3_000_000_000, 39120), ("17", "39120"), (18.0, None), (2**63 - 1, 1), ("19", 75011234), (20.5, 1), ("", 1))]
    path = write(tmp_path / "c.json", customers)
    report = outcomes(etl.load(etl.customers(source.read_customers(spark, path)), root, most_rejected=0.5))
    assert report == {"read": 7, "accepted": 4, "too_long:CUST_ZIP": 1, "not_whole:SSN": 2}
    rows = files.read_current(spark, f"{root}/customer").collect()
    assert sorted((r.SSN, r.CUST_ZIP5) for r in rows) == [
        (17, "39120"), (18, "99999"), (3_000_000_000, "39120"), (2**63 - 1, "00001"),
    ]


def test_a_repeated_key_keeps_its_latest_record(spark, tmp_path):
    root = str(tmp_path / "bank")
    records = [
        {"SSN": 7, "FIRST_NAME": "old", "LAST_UPDATED": "2020-01-01 00:00:00"},
        {"SSN": "7.0", "FIRST_NAME": "new", "LAST_UPDATED": "2021-01-01 00:00:00"},
        {"SSN": "7", "FIRST_NAME": "odd", "LAST_UPDATED": "01.01.2022"},
    ]
    report = outcomes(etl.load(etl.customers(source.read_customers(spark, write(tmp_path / "c.json", records))), root))
    assert report == {"read": 3, "accepted": 1, "duplicate_key": 2}
    found = accounts.customer_lookup(files.read_current(spark, f"{root}/customer"), 7).collect()
    assert [r.FIRST_NAME for r in found] == ["New"]
    assert sorted(r.SSN for r in files.read_current(spark, f"{root}/customer_rejects").collect()) == ["7", "7"]


def versions(root):
    return {str(p.relative_to(root)) for p in Path(root).glob("*/v=*")}


@pytest.mark.parametrize("bad", ["all rejected", "empty", "too many rejected"])
def test_a_bad_delivery_leaves_all_tables_as_they_are(spark, tmp_path, deliveries, bad):
    """Also those of the deliveries before it."""
    root = str(tmp_path / "bank")
    etl.load_bank(spark, *deliveries, root, most_rejected=0.7)
    before = versions(root)
    records = {"all rejected": [{"DAY": 1}], "empty": [], "too many rejected": transactions() + [{"DAY": 1}] * 90}[bad]
    third = write(tmp_path / "bad.json", records)
    with pytest.raises(ValueError, match="^transaction: .*(accepted|rejected)"):
        etl.load_bank(spark, *deliveries[:2], third, root, most_rejected=0.7)
    assert versions(root) == before
    assert files.read_current(spark, f"{root}/transaction").count() == 10


def test_the_gate_is_on_by_default(spark, tmp_path, deliveries):
    root = str(tmp_path / "bank")
    with pytest.raises(ValueError, match="branch: 1 of 2 rows rejected"):
        etl.load_bank(spark, *deliveries, root)
    assert files.current_path(spark, f"{root}/branch") is None


def test_loads_keep_few_versions_and_no_copies(spark, tmp_path, deliveries):
    root, scratch = str(tmp_path / "bank"), Path(spark.conf.get("spark.checkpoint.dir"))
    for _ in range(5):
        etl.load_bank(spark, *deliveries, root, most_rejected=0.7)
    assert {v for v in versions(root) if v.startswith("transaction/")} == {f"transaction/v={n}" for n in (3, 4, 5)}
    assert files.read_current(spark, f"{root}/transaction").count() == 10
    assert not list(scratch.glob("staged-branch-*")) and not list(scratch.glob("staged-transaction-*"))


def test_documents_over_many_lines_are_refused(spark, tmp_path):
    files.create_loan_table(spark, "loan_lines", str(tmp_path / "table"))
    path = tmp_path / "l.json"
    path.write_text(json.dumps([{"Application_ID": "LP1"}, {"Application_ID": "LP2"}], indent=2))
    with pytest.raises(ValueError, match="multi_line=True"):
        etl.load_loans(spark, str(path), "loan_lines", str(tmp_path / "rejects"))
    report = etl.load_loans(spark, str(path), "loan_lines", str(tmp_path / "rejects"), multi_line=True)
    assert outcomes(report) == {"read": 2, "accepted": 2}
    spark.sql("DROP TABLE loan_lines")


def test_partitions_answer_months_and_ranges(spark, tmp_path, deliveries):
    """Top months read no data column; ranges and bills only the months they name."""
    root = str(tmp_path / "bank")
    etl.load_bank(spark, *deliveries, root, most_rejected=0.7)
    txn = files.read_current(spark, f"{root}/transaction")
    text = plan(reports.top_months(txn))
    assert "ReadSchema: struct<>" in text and "isnotnull(TXN_YEAR" in text
    text = plan(accounts.transactions_between(txn, 1, dt.date(2018, 12, 31), dt.date(2019, 1, 2)))
    assert "PartitionFilters" in text and "24228" in text and "24229" in text
    requests = spark.createDataFrame([("4", 2018, 2), ("4", 1990, 1)], "CUST_CC_NO string, YEAR int, MONTH int")
    bills = accounts.monthly_bill_bulk(txn, requests)
    assert [(r.TXN_MONTH, r.TRANSACTION_ID) for r in bills.collect()] == [(2, n) for n in (1, 3, 5, 7, 9)]
    assert re.search(r"PartitionFilters: \[[^\]]*(IN|INSET)", plan(bills))
    assert "EqualTo(TRANSACTION_TYPE_KEY,gas)" in plan(reports.type_total(txn, "GAS", ignore_case=True))


def test_loan_documents_are_added_once(spark, tmp_path):
    rejects = str(tmp_path / "rejects")
    files.create_loan_table(spark, "loan_etl", str(tmp_path / "table"))
    (tmp_path / "d1").mkdir(), (tmp_path / "d2").mkdir()
    write(tmp_path / "d1" / "a.json", [[{"Application_ID": "LP1"}, {"Application_ID": "LP2"}, {"Application_ID": "LP2"}], [{"Gender": "Male"}], "[{broken"])
    write(tmp_path / "d2" / "a.json", [[{"Application_ID": "LP2"}, {"Application_ID": "LP3", "Credit_History": 1}]])

    report = outcomes(etl.load_loans(spark, str(tmp_path / "d1"), "loan_etl", rejects, most_rejected=0.4))
    assert report == {"read": 5, "accepted": 2, "duplicate_key": 1, "missing:Application_ID": 1, "corrupt_record": 1}
    left_out = files.read_current(spark, rejects).groupBy("reject_reason").agg(F.sum("copies").alias("n")).collect()
    assert {r.reject_reason: r.n for r in left_out} == {"duplicate_key": 1, "missing:Application_ID": 1, "corrupt_record": 1}

    report = {r.outcome: r.rows for r in etl.load_loans(spark, str(tmp_path / "d2"), "loan_etl", rejects).collect()}
    assert report == {"read": 2, "accepted": 1, "already_stored": 1}
    assert [(r.Application_ID, r.reject_reason, r.copies) for r in files.read_current(spark, rejects).collect()] == [
        ("LP2", "already_stored", 1)
    ]
    assert sorted(r.Application_ID for r in spark.table("loan_etl").collect()) == ["LP1", "LP2", "LP3"]

    with pytest.raises(ValueError, match="rejected"):
        etl.load_loans(spark, str(tmp_path / "d1"), "loan_etl", rejects, most_rejected=0.1)
    assert spark.table("loan_etl").count() == 3
    spark.sql("DROP TABLE loan_etl")


def test_a_large_load_of_loans_broadcasts_no_keys(spark, tmp_path, monkeypatch):
    from ledgerline.operators import quality

    found = []
    for name in ("already_stored", "new_only"):
        real = getattr(quality, name)
        monkeypatch.setattr(quality, name, lambda *args, real=real: found.append(real(*args)) or found[-1])
    monkeypatch.setattr(quality, "MOST_NAMED", 2)
    files.create_loan_table(spark, "loan_many", str(tmp_path / "table"))
    for number in range(2):
        path = write(tmp_path / f"{number}.json", [[{"Application_ID": f"LP{n + number}"} for n in range(4)]])
        plans = len(found)
        etl.load_loans(spark, path, "loan_many", str(tmp_path / "rejects"))
        assert not [x for x in found[plans:] if "Broadcast" in plan(x)]
    assert sorted(r.Application_ID for r in spark.table("loan_many").collect()) == [f"LP{n}" for n in range(5)]
    spark.sql("DROP TABLE loan_many")


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for folder in folders for p in Path(str(folder)).rglob("shuffle_*.data")}


def test_a_load_of_loans_leaves_no_shuffle_files(spark, tmp_path):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files.create_loan_table(spark, "loan_tidy", str(tmp_path / "table"))
    path = write(tmp_path / "l.json", [[{"Application_ID": f"LP{n % 30}", "Income": str(n % 7)} for n in range(100)]])
    before, was = shuffle_files(spark), spark.conf.get(setting, None)
    report = etl.load_loans(spark, path, "loan_tidy", str(tmp_path / "rejects"))
    for _ in range(50):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(setting, None) == was
    assert outcomes(report) == {"read": 100, "accepted": 30, "duplicate_key": 70}
    assert files.read_current(spark, str(tmp_path / "rejects")).agg(F.sum("copies")).first()[0] == 70
    spark.sql("DROP TABLE loan_tidy")


def test_the_documents_of_the_loan_queries_are_packed_and_go_after_their_load(spark, monkeypatch):
    from ledgerline import schemas
    from ledgerline.plans import queries

    own = {"Application_ID": "concat('LP', lpad(id div 2, 12, '0'))", "Credit_History": "'1'"}
    loans = lambda n: spark.range(n).selectExpr(*(f"{own.get(c, repr(c[:8]))} AS {c}" for c in schemas.LOAN_COLUMNS))
    monkeypatch.setattr(queries.v, "earlier_loans", lambda *_: loans(2000).distinct())
    monkeypatch.setattr(queries.v, "loan_feed", lambda *_: loans(6000))
    real, found = etl.load_loans, []

    def noted(spark, documents, *args, **more):
        parts = [p.stat().st_size for p in Path(documents.removeprefix("file:")).glob("part-*")]
        found.append((documents, sum(parts), sum(len(r.value) for r in spark.read.text(documents).collect())))
        return real(spark, documents, *args, **more)

    monkeypatch.setattr(etl, "load_loans", noted)
    report = outcomes(queries.loan_load_report(spark, "unused"))
    assert report == {"read": 6000, "accepted": 2000, "already_stored": 1000, "duplicate_key": 3000}
    assert len(found) == 2
    for documents, packed, plain in found:
        assert packed * 5 < plain
        assert not Path(documents.removeprefix("file:")).exists()
