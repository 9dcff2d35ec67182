from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from conftest import final_plan, plan
from ledgerline.operators import reports

TXN = (
    "CUST_CC_NO string, TXN_DATE date, CUST_SSN int, BRANCH_CODE int, "
    "TRANSACTION_TYPE string, TRANSACTION_VALUE decimal(18,2), TRANSACTION_ID bigint"
)
TYPES = ["Gas", "Healthcare", "Bills", "Grocery"]


def make(n):
    day = None if n % 4 == 0 else dt.date(2018, 1 + n % 5, 1 + n % 28)
    return (f"4{n % 13}", day, n % 13, n % 7, TYPES[(n * n) % 4], Decimal(n * 37 % 10007) / 100, n)


ROWS = [make(n) for n in range(1, 2001)]


@pytest.fixture(scope="module")
def txn(spark):
    return spark.createDataFrame(ROWS, TXN)


@pytest.fixture(scope="module")
def branches(spark):
    return spark.createDataFrame([(c, "NY" if c < 3 else "FL") for c in range(6)], "BRANCH_CODE int, BRANCH_STATE string")


def tuples(df):
    return [tuple(r) for r in df.collect()]


def totals(key, rows=ROWS):
    sums = defaultdict(Decimal)
    for row in rows:
        sums[row[key]] += row[5]
    return dict(sums)


def ranked(groups, k=None):
    return sorted(groups.items(), key=lambda kv: (-kv[1], kv[0]))[:k]


def test_counts_by_type_in_descending_order(txn):
    assert tuples(reports.txn_count_by_type(txn)) == ranked(Counter(r[4] for r in ROWS))


def test_share_of_all_transactions(txn):
    rows = reports.txn_count_by_type_share(txn).collect()
    assert {r.TOTAL for r in rows} == {2000}
    assert sum(r.PCT for r in rows) == pytest.approx(100, abs=1e-3)
    top = rows[0]
    assert top.PCT == pytest.approx(top.TXN_COUNT / 20)
    assert top.PCT_LABEL == f"{top.PCT:.1f}% ({top.TXN_COUNT})"


def test_share_reuses_the_groups(txn):
    text = final_plan(reports.with_share(reports.counts(txn, "TRANSACTION_TYPE", "n"), "n"))
    assert "ReusedExchange" in text and "Window" not in text


def test_top_customers(txn):
    rows = reports.top_customers(txn).collect()
    assert [(r.CUST_SSN, r.TOTAL_VALUE) for r in rows] == ranked(totals(2), 10)
    assert rows[0].LABEL == f"{rows[0].CUST_SSN} (${rows[0].TOTAL_VALUE:.2f})"


def test_top_customers_share_is_of_the_top(txn):
    rows = reports.top_customers_share(txn, 4).collect()
    assert len(rows) == 4 and {r.TOTAL for r in rows} == {sum(v for _, v in ranked(totals(2), 4))}
    assert sum(r.PCT for r in rows) == pytest.approx(100, abs=1e-3)


def test_top_k_is_not_a_full_sort(txn):
    text = plan(reports.top_customers(txn)).split("== Physical Plan ==")[1]
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_months_leave_undated_rows_out_before_the_limit(txn):
    months = Counter((r[1].year, r[1].month) for r in ROWS if r[1])
    expected = [(y, m, n) for (y, m), n in ranked(months, 3)]
    rows = reports.top_months(txn).collect()
    assert [(r.YEAR, r.MONTH, r.TXN_COUNT) for r in rows] == expected
    assert rows[0].LABEL == f"{rows[0].YEAR}-{rows[0].MONTH:02d}"


def test_undated_rows_cannot_take_a_place(spark):
    rows = [("4", None, 1, 1, "Gas", Decimal(1), n) for n in range(9)]
    rows += [("4", dt.date(2018, m, 1), 1, 1, "Gas", Decimal(1), m) for m in (1, 2, 3)]
    found = reports.top_months(spark.createDataFrame(rows, TXN)).collect()
    assert [r.MONTH for r in found] == [1, 2, 3]


def test_tied_months_go_by_date(spark):
    days = [dt.date(2018, 5, 1)] * 3 + [dt.date(2018, 4, 1)] * 2 + [dt.date(2019, 1, 1), dt.date(2018, 9, 1), dt.date(2018, 2, 1)]
    txn = spark.createDataFrame([("4", d, 1, 1, "Gas", Decimal(1), n) for n, d in enumerate(days)], TXN)
    assert [(r.YEAR, r.MONTH) for r in reports.top_months(txn).collect()] == [(2018, 5), (2018, 4), (2018, 2)]


def test_month_shares(txn):
    rows = reports.top_months_share(txn).collect()
    assert sum(r.PCT for r in rows) == pytest.approx(100, abs=1e-3)
    assert rows[0].PCT_LABEL.endswith("%")


def test_branches_for_a_type(txn):
    rows = reports.top_branches_for_type(txn, "Healthcare", 5).collect()
    expected = ranked(totals(3, [r for r in ROWS if r[4] == "Healthcare"]), 5)
    assert [(r.BRANCH_CODE, r.TOTAL_VALUE) for r in rows] == expected
    assert [r.WHOLE_VALUE for r in rows] == [int(v) for _, v in expected]


def test_type_match_is_exact_unless_asked(txn):
    assert reports.top_branches_for_type(txn, "HEALTHCARE").count() == 0
    upper = reports.top_branches_for_type(txn, "HEALTHCARE", ignore_case=True)
    assert tuples(upper) == tuples(reports.top_branches_for_type(txn, "Healthcare"))


def test_type_totals(txn):
    counts, sums = Counter(r[4] for r in ROWS), totals(4)
    assert {r[0]: tuple(r[1:]) for r in tuples(reports.type_totals(txn))} == {t: (counts[t], sums[t]) for t in counts}
    assert tuples(reports.type_total(txn, "Gas")) == [(counts["Gas"], sums["Gas"])]
    assert tuples(reports.type_total(txn, "none")) == [(0, None)]


def test_branch_state_totals(txn, branches):
    state = {c: "NY" if c < 3 else "FL" for c in range(6)}
    expected = defaultdict(lambda: [0, Decimal(0)])
    for row in ROWS:
        if row[3] in state:
            expected[state[row[3]]][0] += 1
            expected[state[row[3]]][1] += row[5]
    got = {r.BRANCH_STATE: [r.TXN_COUNT, r.TOTAL_VALUE] for r in reports.branch_state_totals(txn, branches).collect()}
    assert got == dict(expected)
    assert [r.TXN_COUNT for r in reports.branch_state_total(txn, branches, "NY").collect()] == [expected["NY"][0]]


def test_state_totals_join_after_summing(txn, branches):
    text = plan(reports.branch_state_totals(txn, branches)).split("== Physical Plan ==")[1]
    join = text.index("Join")
    assert "HashAggregate(keys=[BRANCH_CODE" in text[join:]


def test_zip_and_month(spark, txn):
    customers = spark.createDataFrame([(s, 7501 if s % 2 else 60601) for s in range(13)], "SSN int, CUST_ZIP int")
    rows = reports.txn_by_zip_month(txn, customers, 7501, 2018, 3).collect()
    expected = [r for r in ROWS if r[1] and r[1].month == 3 and r[2] % 2]
    expected.sort(key=lambda r: (-r[1].toordinal(), r[6]))
    assert [r.TRANSACTION_ID for r in rows] == [r[6] for r in expected]
    assert {r.CUST_ZIP for r in rows} == {7501}


def test_leaders_keep_ties(spark):
    customers = spark.createDataFrame([(1, "NY"), (2, "NY"), (3, "FL"), (4, "FL"), (5, "IA")], "SSN int, CUST_STATE string")
    by_state = reports.customers_by_state(customers)
    assert tuples(by_state) == [("FL", 2), ("NY", 2), ("IA", 1)]
    found = reports.leaders(reports.counts(customers, "CUST_STATE", "n"), "n")
    assert sorted(tuples(found)) == [("FL", 2), ("NY", 2)]


def test_totals_do_not_depend_on_order(spark):
    rows = [("4", None, 1, 1, "Gas", Decimal("0.10"), n) for n in range(1000)]
    assert tuples(reports.totals(spark.createDataFrame(rows, TXN).repartition(7), "CUST_SSN")) == [(1, Decimal("100.00"))]
