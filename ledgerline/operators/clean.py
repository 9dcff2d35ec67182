"""Clean-up projections from delivered records to stored tables.

Each is narrow (no shuffle) and meant for ``df.transform``. Columns may be typed or
text as delivered; text must have passed the rules of ``operators.quality``. Numbers that several
columns are made of are columns of an inner projection, so that a text is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions import columns as fn


def _col(df: DataFrame, name: str, kind: str) -> Column:
    """The column, or a typed NULL when the delivery has none."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _is_text(df: DataFrame, name: str) -> bool:
    return name in df.columns and df.schema[name].dataType.simpleString() == "string"


def _whole(df: DataFrame, name: str, kind: str = "bigint") -> Column:
    """The column as a whole number of type ``kind``."""
    value = _col(df, name, kind)
    return (fn.whole_number(value) if _is_text(df, name) else value).try_cast(kind)


def _time(df: DataFrame, name: str) -> Column:
    """The column as a time; a text in another format is unknown."""
    return F.col(name).try_cast("timestamp") if _is_text(df, name) else F.col(name)


def clean_branch(raw: DataFrame) -> DataFrame:
    zip_code = fn.zip_or_unknown(F.col("_zip"))
    return raw.withColumn("_zip", _whole(raw, "BRANCH_ZIP")).select(
        _whole(raw, "BRANCH_CODE").alias("BRANCH_CODE"),
        "BRANCH_NAME",
        "BRANCH_STREET",
        "BRANCH_CITY",
        "BRANCH_STATE",
        zip_code.alias("BRANCH_ZIP"),
        fn.zip_text(zip_code).alias("BRANCH_ZIP5"),
        fn.us_phone(F.col("BRANCH_PHONE")).alias("BRANCH_PHONE"),
        _time(raw, "LAST_UPDATED").alias("LAST_UPDATED"),
    )


def clean_customer(raw: DataFrame) -> DataFrame:
    zip_code = fn.zip_or_unknown(F.col("_zip"))
    return raw.withColumn("_zip", _whole(raw, "CUST_ZIP")).select(
        _whole(raw, "SSN").alias("SSN"),
        F.initcap("FIRST_NAME").alias("FIRST_NAME"),
        F.lower("MIDDLE_NAME").alias("MIDDLE_NAME"),
        F.initcap("LAST_NAME").alias("LAST_NAME"),
        F.col("CREDIT_CARD_NO").alias("Credit_card_no"),
        fn.street_address(F.col("APT_NO"), F.col("STREET_NAME")).alias("FULL_STREET_ADDRESS"),
        "CUST_CITY",
        "CUST_STATE",
        "CUST_COUNTRY",
        zip_code.alias("CUST_ZIP"),
        fn.zip_text(zip_code).alias("CUST_ZIP5"),
        fn.us_phone(F.col("CUST_PHONE")).alias("CUST_PHONE"),
        "CUST_EMAIL",
        _time(raw, "LAST_UPDATED").alias("LAST_UPDATED"),
    )


def clean_transaction(raw: DataFrame) -> DataFrame:
    """One date instead of three parts; the card column gets its stored name."""
    parts = {f"_{part}": _whole(raw, part, "int") for part in ("YEAR", "MONTH", "DAY")}
    dated = raw.withColumns(parts).withColumn("_date", fn.calendar_date(*map(F.col, parts)))
    date = F.col("_date")
    value = fn.amount(F.col("TRANSACTION_VALUE")) if _is_text(raw, "TRANSACTION_VALUE") else fn.money(F.col("TRANSACTION_VALUE"))
    return dated.select(
        F.col("CREDIT_CARD_NO").alias("CUST_CC_NO"),
        fn.time_id(date).alias("TIMEID"),
        date.alias("TXN_DATE"),
        _whole(raw, "CUST_SSN").alias("CUST_SSN"),
        _whole(raw, "BRANCH_CODE").alias("BRANCH_CODE"),
        "TRANSACTION_TYPE",
        value.alias("TRANSACTION_VALUE"),
        _whole(raw, "TRANSACTION_ID").alias("TRANSACTION_ID"),
    )


def with_month_columns(txn: DataFrame) -> DataFrame:
    """Partition columns of the stored fact table."""
    return txn.withColumns({"TXN_YEAR": F.year("TXN_DATE"), "TXN_MONTH": F.month("TXN_DATE")})


# Stored beside the type, so that a search that ignores case reaches the scan.
TYPE_KEY = "TRANSACTION_TYPE_KEY"


def as_stored_transactions(txn: DataFrame) -> DataFrame:
    """The fact table: type in small letters, and the partition columns last."""
    return with_month_columns(txn.withColumn(TYPE_KEY, F.lower("TRANSACTION_TYPE")))


def ignoring_case(df: DataFrame, *names: str) -> DataFrame:
    """The columns with a collation under which comparing and grouping ignore case.

    For reports over data whose spelling varies (``yes``, ``Yes``).
    """
    return df.withColumns({name: F.collate(name, "UTF8_LCASE") for name in names})
