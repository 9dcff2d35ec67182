from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as fn


def one(spark, expression, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("9034417758", "(903)441-7758"),
        ("5551234", "5551234"),
        ("123456789012", "123456789012"),
        ("x1234567890", "x1234567890"),
        ("1234567890\n", "1234567890\n"),
        ("dddddddddd", "dddddddddd"),
        ("", ""),
        (None, None),
    ],
)
def test_phone_formats_exactly_ten_digits(spark, given, expected):
    assert one(spark, fn.us_phone(F.col("x")), row=(given,)) == expected


@pytest.mark.parametrize("given, zip_code, text", [(None, 99999, "99999"), (7501, 7501, "07501"), (60601, 60601, "60601")])
def test_zip_default_and_leading_zeros(spark, given, zip_code, text):
    expression = fn.zip_or_unknown(F.col("x"))
    assert one(spark, expression, "x int", (given,)) == zip_code
    assert one(spark, fn.zip_text(expression), "x int", (given,)) == text


@pytest.mark.parametrize("given, text", [(75011234, "75011234"), (123456, "123456")])
def test_longer_codes_are_not_cut(spark, given, text):
    assert one(spark, fn.zip_text(F.col("x")), "x int", (given,)) == text


@pytest.mark.parametrize(
    "given, expected",
    [
        ("12", 12), (" 12 ", 12), ("1.0", 1), ("1.", 1), ("-3", -3), ("39120", 39120), ("99999999999", 99999999999),
        ("0.5", None), ("12a", None), ("", None), (None, None), ("9" * 19, None), ("1e3", None),
    ],
)
def test_whole_numbers_as_delivered(spark, given, expected):
    assert one(spark, fn.whole_number(F.col("x")), row=(given,)) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("10.5", "10.50"), ("10.120", "10.12"), ("7", "7.00"), ("10.129", None), ("x", None), (None, None), ("-0.01", "-0.01")],
)
def test_amounts_keep_two_decimals_or_none(spark, given, expected):
    found = one(spark, fn.amount(F.col("x")), row=(given,))
    assert (found if found is None else str(found)) == expected


@pytest.mark.parametrize(
    "apartment, street, expected",
    [("4", "Elm", "4, Elm"), (None, "Elm", "Elm"), ("4", None, "4"), (None, None, "")],
)
def test_address_skips_missing_parts(spark, apartment, street, expected):
    expression = fn.street_address(F.col("a"), F.col("s"))
    assert one(spark, expression, "a string, s string", (apartment, street)) == expected


def test_calendar_date_against_the_standard_library(spark):
    parts = list(
        itertools.product(
            [None, -1, 0, 1, 1900, 2000, 2018, 2020, 9999, 10000, 2**31 - 1],
            [None, -(2**31), 0, 1, 2, 4, 11, 12, 13, 2**31 - 1],
            [None, -(2**31), 0, 1, 28, 29, 30, 31, 32, 2**31 - 1],
        )
    )

    def expected(y, m, d):
        try:
            return dt.date(y, m, d)
        except (TypeError, ValueError, OverflowError):
            return None

    rows = spark.createDataFrame(parts, "y int, m int, d int").select(
        "y", "m", "d", fn.calendar_date(F.col("y"), F.col("m"), F.col("d")).alias("r")
    )
    got = {(r.y, r.m, r.d): r.r for r in rows.collect()}
    assert got == {p: expected(*p) for p in parts}


def test_time_id_is_padded_and_sorts_like_the_date(spark):
    dates = [dt.date(2018, 2, 4), dt.date(2018, 10, 1)]
    ids = [r.r for r in spark.createDataFrame([(d,) for d in dates], "x date").select(fn.time_id(F.col("x")).alias("r")).collect()]
    assert ids == ["20180204", "20181001"]
    assert ids == sorted(ids)
    assert one(spark, fn.time_id(F.col("x")), "x date") is None


@pytest.mark.parametrize("year, month, inside, outside", [
    (2018, 12, dt.date(2018, 12, 31), dt.date(2019, 1, 1)),
    (2018, 2, dt.date(2018, 2, 1), dt.date(2018, 1, 31)),
])
def test_in_month_is_half_open(spark, year, month, inside, outside):
    assert one(spark, fn.in_month(F.col("x"), year, month), "x date", (inside,)) is True
    assert one(spark, fn.in_month(F.col("x"), year, month), "x date", (outside,)) is False


def test_labels(spark):
    from decimal import Decimal

    assert one(spark, fn.month_label(F.lit(2018), F.lit(3))) == "2018-03"
    row = ("7", Decimal("1234.50"))
    assert one(spark, fn.amount_label(F.col("k"), F.col("v")), "k string, v decimal(28,2)", row) == "7 ($1234.50)"
    assert one(spark, fn.whole(F.col("v")), "v decimal(18,2)", (Decimal("-12.99"),)) == -12


def test_percent_label_is_rounded_once(spark):
    """12.34996 would be 12.35 with four digits, and then 12.4."""
    assert one(spark, fn.percent_label(F.lit(1234996), F.lit(10000000))) == "12.3%"
    assert one(spark, fn.percent_label(F.lit(1), F.lit(0))) is None


def test_percent_of_nothing_is_null(spark):
    assert one(spark, fn.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.percent(F.lit(1), F.lit(3))) == 33.3333
