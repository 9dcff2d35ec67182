from __future__ import annotations

import itertools

import pytest

from conftest import plan
from ledgerline.operators import clean, loans

SCHEMA = "Gender string, Married string, Education string, Self_Employed string, Property_Area string, Application_Status string"
ROWS = [
    (g, m, e, s, a, "Y" if (i * 7) % 3 else "N")
    for i, (g, m, e, s, a) in enumerate(
        itertools.product(["Male", "Female", None], ["Yes", "No"], ["Graduate", "Not Graduate"], ["Yes", "No"], ["Urban", "Rural"])
    )
]


@pytest.fixture(scope="module")
def applications(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def count(test):
    return sum(1 for r in ROWS if test(r))


def test_status_counts_in_one_scan(applications):
    row = loans.status_counts(applications).first()
    married = [r for r in ROWS if r[0] == "Male" and r[1] == "Yes"]
    assert tuple(row) == (
        len(ROWS), count(lambda r: r[5] == "Y"), count(lambda r: r[3] == "Yes"),
        len(married), sum(r[5] == "N" for r in married),
    )
    assert plan(loans.status_counts(applications)).split("== Physical Plan ==")[1].count("Scan") == 1


def test_self_employed_approval_combines_both_conditions(applications):
    row = loans.approval_rate_self_employed(applications).first()
    both, all_of = count(lambda r: r[3] == "Yes" and r[5] == "Y"), count(lambda r: r[3] == "Yes")
    assert (row.TOTAL, row.APPROVED, row.SELF_EMPLOYED) == (len(ROWS), both, all_of)
    assert row.PCT == pytest.approx(100 * both / all_of, abs=1e-4)


def test_ratio_as_written_may_pass_one_hundred(applications):
    row = loans.approval_rate_self_employed(applications, as_written=True).first()
    assert row.PCT == pytest.approx(100 * count(lambda r: r[5] == "Y") / count(lambda r: r[3] == "Yes"), abs=1e-4)
    assert row.PCT > 100


def test_rejections_of_married_men(applications):
    row = loans.rejection_rate_married_male(applications).first()
    assert row.REJECTED + row.APPROVED == row.TOTAL
    assert row.PCT == pytest.approx(100 * row.REJECTED / row.TOTAL, abs=1e-4)
    split = {r.STATUS: r for r in loans.rejection_split_married_male(applications).collect()}
    assert split["Rejected"].APPLICATIONS == row.REJECTED and split["Approved"].APPLICATIONS == row.APPROVED
    assert split["Rejected"].PCT_LABEL == f"{row.PCT:.1f}%"


def test_rates_without_rows_are_null(applications):
    none = applications.where("Self_Employed = 'never'")
    assert loans.approval_rate_self_employed(none).first().PCT is None
    assert loans.approval_rate_self_employed(none, as_written=True).first().PCT is None
    assert loans.rejection_rate_married_male(none).first().PCT is None


def test_case_can_be_ignored(spark, applications):
    shouted = applications.selectExpr("upper(Gender) Gender", "lower(Married) Married", "Education", "lower(Self_Employed) Self_Employed", "Property_Area", "lower(Application_Status) Application_Status")
    assert loans.status_counts(shouted).first().APPROVED == 0
    folded = clean.ignoring_case(shouted, "Gender", "Married", "Self_Employed", "Application_Status")
    assert loans.status_counts(folded).first() == loans.status_counts(applications).first()
    mixed = clean.ignoring_case(applications.unionByName(shouted), "Gender", "Application_Status")
    assert loans.segment_rates(mixed, ("Gender",)).count() == 4


@pytest.mark.parametrize("how", ["cube", "rollup"])
def test_segment_rates_against_brute_force(applications, how):
    names = list(loans.SEGMENTS)
    n = len(names)
    if how == "cube":
        groupings = [g for k in range(n + 1) for g in itertools.combinations(range(n), k)]
    else:
        groupings = [tuple(range(k)) for k in range(n + 1)]
    expected = {}
    for grouping in groupings:
        for row in ROWS:
            key = (tuple(row[i] if i in grouping else None for i in range(n)), tuple(int(i in grouping) for i in range(n)))
            total, approved = expected.get(key, (0, 0))
            expected[key] = (total + 1, approved + (row[5] == "Y"))
    got = {}
    for r in loans.segment_rates(applications, how=how).collect():
        key = (tuple(r[s] for s in names), tuple(r[f"IN_{s}"] for s in names))
        assert key not in got
        got[key] = (r.APPLICATIONS, r.APPROVED)
        assert r.PCT == pytest.approx(100 * r.APPROVED / r.APPLICATIONS, abs=1e-4)
    assert got == expected


def test_cube_copies_counted_rows_only(applications):
    text = plan(loans.segment_rates(applications)).split("== Physical Plan ==")[1]
    assert "Expand" in text
    assert "HashAggregate" in text[text.index("Expand"):]


def test_frequent_segments_against_every_breakdown(applications):
    """The cube grown from the top holds all breakdowns that are large enough, and no other."""
    for least in (4, 17):
        want = []
        for size in range(1, 6):
            for by in itertools.combinations(range(5), size):
                for values in {tuple(r[i] for i in by) for r in ROWS}:
                    own = [r for r in ROWS if tuple(r[i] for i in by) == values]
                    name = ", ".join(f"{loans.SEGMENTS[i]}={'?' if v is None else v}" for i, v in zip(by, values))
                    if len(own) >= least:
                        want.append((name, size, len(own), sum(r[5] == "Y" for r in own)))
        assert sorted(map(tuple, loans.frequent_segments(applications, least=least).collect())) == sorted(want)


def test_target_segments_rank_by_the_sure_rate(spark):
    data = [("a", "Y")] * 3 + [("b", "Y")] * 180 + [("b", "N")] * 20 + [("c", "Y")] * 50 + [("c", "N")] * 50
    found = loans.target_segments(spark.createDataFrame(data, "Gender string, Application_Status string"), ("Gender",), least=2).collect()
    assert [r.SEGMENT for r in found] == ["Gender=b", "Gender=a", "Gender=c"]  # three of three prove less than 180 of 200
    assert [r.PCT for r in found] == [90.0, 100.0, 50.0]
    assert found[1].LOWER_PCT == pytest.approx(100 * 3 / (3 + 1.96**2), abs=1e-5)
    assert found[0].LOWER_PCT == pytest.approx(85.0593, abs=1e-4)


def test_segments_without_loans(spark):
    empty = spark.createDataFrame([], "Gender string, Married string, Application_Status string")
    assert loans.target_segments(empty, ("Gender", "Married")).count() == 0
