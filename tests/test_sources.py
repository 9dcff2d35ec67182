from __future__ import annotations

import datetime as dt
import json

from ledgerline import schemas
from ledgerline.operators.quality import CORRUPT
from ledgerline.sources import json as source
from ledgerline.sources.tables import JdbcSplit, jdbc_read_options, register_views


def write(path, lines):
    path.write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    return str(path)


def test_branch_scan_uses_the_declared_schema(spark, tmp_path):
    path = write(
        tmp_path / "b.json",
        [{"BRANCH_CODE": 5, "LAST_UPDATED": "2021-03-02T08:15:30.000-04:00", "BRANCH_ZIP": 4207, "OTHER": 1}],
    )
    df = source.read_branches(spark, path, schemas.BRANCH)
    assert df.columns == [*schemas.BRANCH.names, CORRUPT]
    row = df.first()
    assert (row.BRANCH_CODE, row.BRANCH_ZIP) == (5, 4207)
    assert row.LAST_UPDATED == dt.datetime(2021, 3, 2, 12, 15, 30)


def test_a_bad_value_is_null_and_marks_the_record(spark, tmp_path):
    path = write(tmp_path / "c.json", [{"SSN": "many", "FIRST_NAME": "Bo"}, {"SSN": 3}, "{broken"])
    rows = source.read_customers(spark, path, schemas.CUSTOMER).cache().collect()
    assert sorted((r.SSN or 0, r.FIRST_NAME, r[CORRUPT] is not None) for r in rows if r.SSN or r.FIRST_NAME) == [
        (0, "Bo", True), (3, None, False),
    ]
    assert sum(r[CORRUPT] is not None for r in rows) == 2


def test_transaction_values_are_exact(spark, tmp_path):
    path = write(tmp_path / "t.json", [{"TRANSACTION_ID": 1, "TRANSACTION_VALUE": 0.1}, {"TRANSACTION_ID": 2, "TRANSACTION_VALUE": 0.2}])
    values = [r.TRANSACTION_VALUE for r in source.read_transactions(spark, path, schemas.TRANSACTION).collect()]
    assert str(sum(values)) == "0.30"


def test_deliveries_are_read_as_text(spark, tmp_path):
    """A quoted number spoils nothing."""
    path = write(tmp_path / "c.json", [{"SSN": "17", "CUST_ZIP": "39120"}, {"SSN": 18.0, "CUST_ZIP": 39121}])
    rows = source.read_customers(spark, path).orderBy("SSN").collect()
    assert [(r.SSN, r.CUST_ZIP, r[CORRUPT]) for r in rows] == [("17", "39120", None), ("18.0", "39121", None)]


LOANS = [{"Application_ID": "LP1", "Credit_History": 1}, {"Application_ID": "LP2", "Gender": "Male"}]


def test_loan_documents_one_per_line(spark, tmp_path):
    path = write(tmp_path / "l.json", [LOANS, [{"Application_ID": "LP3"}]])
    rows = source.read_loans(spark, path).orderBy("Application_ID").collect()
    assert [(r.Application_ID, r.Gender, r.Credit_History) for r in rows] == [
        ("LP1", None, "1"), ("LP2", "Male", None), ("LP3", None, None),
    ]


def test_loan_documents_over_many_lines(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for number, loans in enumerate([LOANS, [{"Application_ID": "LP3"}]]):
        (tmp_path / "d" / f"{number}.json").write_text(json.dumps(loans, indent=2))
    rows = source.read_loans(spark, str(tmp_path / "d"), multi_line=True).collect()
    assert sorted(r.Application_ID for r in rows) == ["LP1", "LP2", "LP3"]


def test_one_bad_number_does_not_spoil_its_document(spark, tmp_path):
    path = write(tmp_path / "l.json", [[{"Application_ID": "LP1", "Credit_History": "x"}, {"Application_ID": "LP2", "Credit_History": 0}]])
    rows = source.read_loans(spark, path).orderBy("Application_ID").collect()
    assert [(r.Credit_History, r[CORRUPT]) for r in rows] == [("x", None), ("0", None)]


def test_reading_starts_no_job_to_infer_types(spark, tmp_path):
    path = write(tmp_path / "b.json", [{"BRANCH_CODE": 5}])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("schema", "reads")
    source.read_branches(spark, path)
    assert list(tracker.getJobIdsForGroup("schema")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_views_answer_sql_with_bound_parameters(spark):
    register_views({"loan_application": spark.createDataFrame([("LP1",), ("LP2",)], "Application_ID string")})
    rows = spark.sql("SELECT * FROM loan_application WHERE Application_ID = :id", args={"id": "LP2"}).collect()
    assert [r.Application_ID for r in rows] == ["LP2"]


def test_jdbc_read_is_partitioned():
    split = JdbcSplit("SSN", 1, 1000, 8)
    options = jdbc_read_options("jdbc:mysql://host/bank", "customer", "driver.Class", split, user="u")
    assert options["partitionColumn"] == "SSN" and options["numPartitions"] == "8"
    assert options["lowerBound"] == "1" and options["upperBound"] == "1000" and options["user"] == "u"
