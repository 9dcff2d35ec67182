from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import final_plan
from ledgerline import schemas
from ledgerline.operators import quality as q

FEED = schemas.LOAN_FEED
BLANK = dict.fromkeys(schemas.LOAN_COLUMNS)


def loans(spark, *records):
    return spark.createDataFrame([tuple({**BLANK, **r}.values()) for r in records], FEED)


def flagged(spark, *records):
    return q.flag(loans(spark, *records), q.loan_rules())


def reasons(df):
    return [r[q.REASON] for r in df.collect()]


@pytest.mark.parametrize(
    "record, reason",
    [
        ({"Application_ID": "LP1", "Credit_History": "1"}, None),
        ({"Application_ID": "L" * 20}, None),
        ({"Application_ID": "L" * 25}, "too_long:Application_ID"),
        ({"Gender": "Male"}, "missing:Application_ID"),
        ({"Application_ID": "LP1", "Dependents": "x" * 11}, "too_long:Dependents"),
        ({"Application_ID": "LP1", "Credit_History": "one"}, "not_whole:Credit_History"),
        ({"Application_ID": "LP1", "Credit_History": None}, None),
        ({"Gender": "x" * 11, "Credit_History": "one"}, "missing:Application_ID"),
    ],
)
def test_loan_rules(spark, record, reason):
    assert reasons(flagged(spark, record)) == [reason]


def test_corrupt_records_are_rejected_first(spark):
    batch = loans(spark, {"Application_ID": "LP1"}).withColumn(q.CORRUPT, F.lit("{broken"))
    assert reasons(q.flag(batch, q.loan_rules())) == ["corrupt_record"]


def outcome(df, key="Application_ID"):
    """(accepted rows, rejected rows with reason) as counted tuples."""
    names = schemas.LOAN_COLUMNS
    kept = Counter(tuple(r[n] for n in names) for r in q.accepted(df, key).collect())
    left = Counter()
    for r in q.rejected(df, key).collect():
        left[(*[r[n] for n in names], r[q.REASON])] += r.copies
    return kept, left


def brute_force(rows):
    kept, left, by_key = Counter(), Counter(), {}
    for *row, reason in rows:
        if reason:
            left[(*row, reason)] += 1
        else:
            by_key.setdefault(row[0], []).append(tuple(row))
    for group in by_key.values():
        first, *rest = sorted(group, key=lambda row: [(v is not None, v or "") for v in row])
        kept[first] += 1
        for row in rest:
            left[(*row, q.DUPLICATE)] += 1
    return kept, left


def test_each_row_is_accepted_or_rejected_once(spark):
    df = flagged(
        spark,
        {"Application_ID": "LP1", "Gender": "Male"},
        {"Application_ID": "LP1", "Gender": "Female"},
        {"Application_ID": "LP1", "Gender": "Female"},
        {"Application_ID": "LP1"},
        {"Application_ID": "LP2", "Gender": "x" * 11},
        {"Application_ID": "LP2", "Gender": "x" * 11},
        {"Application_ID": "LP3", "Income": "low"},
        {"Gender": "Male"},
    )
    assert outcome(df) == brute_force([tuple(r) for r in df.collect()])


def hot_feed(spark):
    """6000 records: a third share one key, a third of those are equal to each other."""
    n = F.col("id")
    columns = {name: F.lit(None).cast("string") for name in schemas.LOAN_COLUMNS}
    columns["Application_ID"] = F.when(n < 2000, F.lit("LP-HOT")).when(n < 5000, F.concat(F.lit("LP"), (n / 2).cast("int").cast("string"))).when(n < 5900, F.concat(F.lit("LP"), n.cast("string")))
    columns["Income"] = F.when(n < 700, F.lit("same")).otherwise(n.cast("string"))
    columns["Credit_History"] = F.when(n > 5800, F.lit("bad")).otherwise(F.lit("1"))
    batch = spark.range(0, 6000, 1, 6).select(*[c.alias(name) for name, c in columns.items()])
    return q.flag(batch, q.loan_rules())


def test_hot_key_against_brute_force(spark):
    df = hot_feed(spark)
    assert outcome(df) == brute_force([tuple(r) for r in df.collect()])


def test_report_agrees_with_the_rows(spark):
    df = hot_feed(spark)
    kept, left = brute_force([tuple(r) for r in df.collect()])
    expected = Counter({"read": 6000, "accepted": sum(kept.values())})
    for (*_, reason), n in left.items():
        expected[reason] += n
    assert {r.outcome: r.rows for r in q.load_report(df, "Application_ID").collect()} == dict(expected)


def test_without_key_nothing_counts_as_duplicate(spark):
    df = flagged(spark, {"Application_ID": "LP1"}, {"Application_ID": "LP1"}, {})
    assert q.accepted(df).count() == 2
    report = {r.outcome: r.rows for r in q.load_report(df).collect()}
    assert report == {"read": 3, "accepted": 2, "missing:Application_ID": 1}
    assert [(r[q.REASON], r.copies) for r in q.rejected(df).collect()] == [("missing:Application_ID", 1)]


def test_map_tasks_send_one_row_per_key(spark):
    """The plan is read top down: a group limit on either side of the shuffle."""
    final = final_plan(q.accepted(hot_feed(spark), "Application_ID")).split("Initial Plan")[0]
    after, before = final.split("Exchange hashpartitioning(Application_ID")
    assert "WindowGroupLimit" in after and "Final" in after
    assert "WindowGroupLimit" in before and "Partial" in before


def test_reject_rate_gate(spark):
    """Repeated keys are no defect of the delivery."""
    df = flagged(spark, {"Application_ID": "LP1"}, {"Application_ID": "LP2"}, {"Application_ID": "LP2"}, {})
    report = q.load_report(df, "Application_ID")
    q.check_reject_rate(report, 0.25)
    with pytest.raises(ValueError, match="1 of 4"):
        q.check_reject_rate(report, 0.24)
    with pytest.raises(ValueError, match="none of 0 rows accepted"):
        q.check_reject_rate(q.load_report(flagged(spark).limit(0), "Application_ID"), 0.0)


def test_an_empty_delivery_has_a_report(spark):
    report = q.load_report(flagged(spark).limit(0), "Application_ID")
    assert {r.outcome: r.rows for r in report.collect()} == {"read": 0, "accepted": 0}


def test_records_lost_in_a_damaged_document_are_counted(spark):
    text = '[{"Application_ID": "LP1"}, {"Application_ID" : "LP2"}, {"Application_ID": "LP3"}, {'
    rows = spark.createDataFrame([(None, text), ("LP9", None)], f"Application_ID string, {q.CORRUPT} string")
    df = q.flag(rows, [q.required("Application_ID")])
    assert {r.outcome: r.rows for r in q.load_report(df, "Application_ID").collect()} == {
        "read": 4, "accepted": 1, "corrupt_record": 1, "lost_in_corrupt": 2,
    }


def test_the_latest_row_of_a_key_stays(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (1, "c", None), (2, "d", None)], "k int, v string, t int")
    df = q.flag(rows, [q.required("k")])
    kept = q.accepted(df, "k", F.col("t"))
    assert sorted(r.v for r in kept.collect()) == ["b", "d"]
    assert sorted((r.v, r[q.REASON]) for r in q.rejected(df, "k", F.col("t")).collect()) == [("a", "duplicate_key"), ("c", "duplicate_key")]


def test_a_small_batch_does_not_shuffle_the_stored_table(spark, tmp_path):
    """The stored side is above the broadcast threshold, the batch far below."""
    path = str(tmp_path / "stored")
    spark.range(200_000).selectExpr("concat('LP', id) as Application_ID").write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        stored = spark.read.parquet(path)
        batch = loans(spark, {"Application_ID": "LP7"}, {"Application_ID": "LX"}).coalesce(1)
        batch.write.parquet(str(tmp_path / "batch"))
        batch = spark.read.parquet(str(tmp_path / "batch"))
        for question, ids in ((q.new_only, ["LX"]), (q.already_stored, ["LP7"])):
            found = question(batch, stored, "Application_ID")
            text = final_plan(found).split("Initial Plan")[0]
            for line in text.splitlines():
                assert not ("Exchange hashpartitioning" in line and "stored" in line)
            assert "SortMergeJoin" not in text
            assert [r.Application_ID for r in found.collect()] == ids
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_new_and_stored_keys(spark):
    batch = loans(spark, {"Application_ID": "LP1"}, {"Application_ID": "LP2"})
    stored = spark.createDataFrame([("LP2",)], "Application_ID string")
    assert [r.Application_ID for r in q.new_only(batch, stored, "Application_ID").collect()] == ["LP1"]
    assert [r.Application_ID for r in q.already_stored(batch, stored, "Application_ID").collect()] == ["LP2"]


def test_duplicate_keys(spark):
    batch = loans(spark, {"Application_ID": "LP1"}, {"Application_ID": "LP1"}, {"Application_ID": "LP2"}, {}, {})
    assert [tuple(r) for r in q.duplicate_keys(batch, "Application_ID").collect()] == [("LP1", 2)]


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_delivered_number_is_parsed_once(spark, tmp_path):
    """Six whole numbers and an amount of a transaction; the conditions on the date name its parts many times."""
    feed = spark.createDataFrame([("4001", "2021", "2", "28", "7", "3", "Gas", "1.50", "1"), ("4001", "2021", "2", "30", "7", "3", "Gas", "1.50", "2")], schemas.TRANSACTION_FEED)
    feed.write.parquet(str(tmp_path / "feed"))
    marked = q.flag(spark.read.parquet(str(tmp_path / "feed")), q.transaction_rules())
    assert optimized(marked).count("RLIKE") == 7
    assert marked.columns == [*feed.columns, q.REASON]
    assert sorted(reasons(marked), key=str) == [None, "no_date:YEAR-MONTH-DAY"]


def test_rules_that_share_a_number_parse_it_once(spark, tmp_path):
    feed = spark.createDataFrame([("7", "123456"), ("8", "x"), ("9", "12345.0")], "SSN string, CUST_ZIP string")
    feed.write.parquet(str(tmp_path / "feed"))
    marked = q.flag(spark.read.parquet(str(tmp_path / "feed")), q.customer_rules())
    assert optimized(marked).count("RLIKE") == 2
    assert sorted(reasons(marked), key=str) == [None, "not_whole:CUST_ZIP", "too_long:CUST_ZIP"]


def test_many_keys_are_not_broadcast(spark, tmp_path):
    """Files hold keys packed, so that Spark takes a long list for a short one."""
    for name, first in (("batch", 0), ("stored", 1000)):
        keys = spark.range(first, first + 5000).selectExpr("concat('LP', lpad(id, 12, '0')) AS Application_ID")
        keys.write.parquet(str(tmp_path / name))
    batch, stored = (spark.read.parquet(str(tmp_path / name)) for name in ("batch", "stored"))
    for question, n in ((q.new_only, 1000), (q.already_stored, 4000)):
        few, many = (question(batch, stored, "Application_ID", named) for named in (5000, q.MOST_NAMED + 1))
        assert "BroadcastHashJoin" in final_plan(few) and "Broadcast" not in final_plan(many)
        assert sorted(few.collect()) == sorted(many.collect()) and many.count() == n


def test_accepted_rows_that_are_written_are_not_made_again(spark, monkeypatch):
    rows = [("LP1", "a", None), ("LP1", "b", None), ("LP1", "b", None), ("LP2", "a", None), (None, "a", "missing:Application_ID")] + [("LP3", "c", None)] * 3
    flagged = spark.createDataFrame(rows, "Application_ID string, Income string, reject_reason string")
    want = sorted(map(tuple, q.rejected(flagged, "Application_ID").collect()), key=str)
    kept = q.accepted(flagged, "Application_ID").localCheckpoint()
    monkeypatch.setattr(q, "accepted", None)
    assert sorted(map(tuple, q.rejected(flagged, "Application_ID", kept=kept).collect()), key=str) == want
    assert [r[3] for r in want] == [2, 2, 1]
