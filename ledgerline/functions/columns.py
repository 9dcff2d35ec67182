"""Column expressions shared by the operators. Built-in functions only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from ledgerline.schemas import MONEY

# Fixed value: the ZIP code stored when none is known.
UNKNOWN_ZIP = 99999


# Whole numbers as deliveries spell them, also as ``7.0``; two decimals at most.
WHOLE = r"^[+-]?[0-9]{1,19}(?:\.0*)?$"
AMOUNT = r"^[+-]?[0-9]{1,16}(?:\.[0-9]{0,2}0*)?$"


def whole_number(text: Column) -> Column:
    """BIGINT of a delivered text, NULL when it is no whole number."""
    text = F.trim(text)
    return F.when(text.rlike(WHOLE), F.substring_index(text, ".", 1).try_cast("bigint"))


def amount(text: Column) -> Column:
    """Money of a delivered text, NULL when it has more than two decimals or is no number."""
    text = F.trim(text)
    return F.when(text.rlike(AMOUNT), text.try_cast(MONEY))


def zip_or_unknown(value: Column) -> Column:
    return F.when(value.isNull(), UNKNOWN_ZIP).otherwise(value.cast("int"))


def padded(value: Column, width: int) -> Column:
    """Zeros in front up to ``width`` characters; longer values stay whole."""
    text = value.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def zip_text(zip_code: Column) -> Column:
    """Five characters at least; the numeric form loses leading zeros."""
    return padded(zip_code, 5)


def us_phone(value: Column) -> Column:
    """``(AAA)BBB-CCCC`` for exactly ten digits, anything else unchanged."""
    formatted = F.concat(
        F.lit("("), F.substring(value, 1, 3), F.lit(")"),
        F.substring(value, 4, 3), F.lit("-"), F.substring(value, 7, 4),
    )
    return F.when(value.rlike(r"^[0-9]{10}\z"), formatted).otherwise(value)


def street_address(apartment: Column, street: Column) -> Column:
    """Parts that are NULL are left out; without any part the text is empty."""
    return F.concat_ws(", ", apartment, street)


def calendar_date(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts, NULL when a part is missing or the day does not exist.

    Out-of-range parts become NULL before ``make_date`` sees them, since that
    raises on them. Integer arithmetic only, no text is built or parsed. The parts
    are named many times over: give them as columns and not as long expressions.
    """
    year = F.when(year.between(1, 9999), year)
    month = F.when(month.between(1, 12), month)
    day = F.when(day.between(1, 31), day)
    first = F.make_date(year, month, F.lit(1))
    return F.when(day <= F.dayofmonth(F.last_day(first)), F.date_add(first, day - 1))


def time_id(date: Column) -> Column:
    """Date key YYYYMMDD, which sorts like the date."""
    return F.date_format(date, "yyyyMMdd")


def in_month(date: Column, year: int, month: int) -> Column:
    """Half-open date range, so both bounds reach the Parquet scan."""
    first = dt.date(year, month, 1)
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return (date >= F.lit(first)) & (date < F.lit(following))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)


def amount_label(key: Column, amount: Column) -> Column:
    """``key ($1234.56)``"""
    return F.concat(key.cast("string"), F.lit(" ($"), amount.cast("decimal(38,2)").cast("string"), F.lit(")"))


def whole(amount: Column) -> Column:
    """Whole units, cut toward zero."""
    return amount.cast("decimal(38,2)").cast("bigint")


def percent(part: Column, of: Column, digits: int = 4) -> Column:
    """Percentage as DOUBLE; NULL when there is nothing to divide by."""
    return F.round(part.cast("double") * 100 / F.nullif(of.cast("double"), F.lit(0.0)), digits)


def percent_label(part: Column, of: Column) -> Column:
    """``12.3%``, rounded once from the exact ratio."""
    return F.concat(percent(part, of, 1).cast("decimal(20,1)").cast("string"), F.lit("%"))
