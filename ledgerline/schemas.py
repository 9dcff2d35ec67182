"""Input and stored schemas. Fixed, so no read needs an inference pass."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# Names, order and types of the delivered columns. Keys are BIGINT,
# since key spaces may pass INT.

BRANCH = _struct(
    ("BRANCH_CODE", T.LongType()),
    ("BRANCH_NAME", T.StringType()),
    ("BRANCH_STREET", T.StringType()),
    ("BRANCH_CITY", T.StringType()),
    ("BRANCH_STATE", T.StringType()),
    ("BRANCH_ZIP", T.IntegerType()),
    ("BRANCH_PHONE", T.StringType()),
    ("LAST_UPDATED", T.TimestampType()),
)

CUSTOMER = _struct(
    ("SSN", T.LongType()),
    ("FIRST_NAME", T.StringType()),
    ("MIDDLE_NAME", T.StringType()),
    ("LAST_NAME", T.StringType()),
    ("CREDIT_CARD_NO", T.StringType()),
    ("STREET_NAME", T.StringType()),
    ("APT_NO", T.StringType()),
    ("CUST_CITY", T.StringType()),
    ("CUST_STATE", T.StringType()),
    ("CUST_COUNTRY", T.StringType()),
    ("CUST_ZIP", T.IntegerType()),
    ("CUST_PHONE", T.StringType()),
    ("CUST_EMAIL", T.StringType()),
    ("LAST_UPDATED", T.TimestampType()),
)

TRANSACTION = _struct(
    ("CREDIT_CARD_NO", T.StringType()),
    ("YEAR", T.IntegerType()),
    ("MONTH", T.IntegerType()),
    ("DAY", T.IntegerType()),
    ("CUST_SSN", T.LongType()),
    ("BRANCH_CODE", T.LongType()),
    ("TRANSACTION_TYPE", T.StringType()),
    ("TRANSACTION_VALUE", MONEY),
    ("TRANSACTION_ID", T.LongType()),
)

# Longest text each loan column may hold (fixed values of the loan table).
LOAN_LENGTHS = {
    "Application_ID": 20,
    "Gender": 10,
    "Married": 10,
    "Dependents": 10,
    "Education": 20,
    "Self_Employed": 10,
    "Property_Area": 20,
    "Income": 20,
    "Application_Status": 10,
}

LOAN_COLUMNS = [
    "Application_ID",
    "Gender",
    "Married",
    "Dependents",
    "Education",
    "Self_Employed",
    "Credit_History",
    "Property_Area",
    "Income",
    "Application_Status",
]

def as_delivered(schema: T.StructType) -> T.StructType:
    """The same columns as text: a quoted or odd number spoils one field and not
    its record, and rejected rows keep what was delivered."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])


BRANCH_FEED = as_delivered(BRANCH)
CUSTOMER_FEED = as_delivered(CUSTOMER)
TRANSACTION_FEED = as_delivered(TRANSACTION)
LOAN_FEED = _struct(*[(name, T.StringType()) for name in LOAN_COLUMNS])


def loan_ddl_columns() -> str:
    """Column list of the stored loan table, with its length limits."""
    return ", ".join(
        f"{name} VARCHAR({LOAN_LENGTHS[name]})" if name in LOAN_LENGTHS else f"{name} INT"
        for name in LOAN_COLUMNS
    )
