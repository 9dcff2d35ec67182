"""The bank's tables as views over the supplied test tables (see FIXTURES.md).

Each view is a fact table with lookups joined to the left on a unique key. Such
a join adds columns and never rows, so lookups no wanted column needs are left
out, as a stored star table would let Spark prune them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.operators import clean, quality

# Columns of the supplied tables. Given, they save Spark the job
# that reads file footers for them.
_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

_UPDATED = "timestamp'2021-09-30 07:15:44'"


def _wide(key: str, width: int) -> str:
    """The key as text, with zeros in front up to ``width``; a longer key stays whole."""
    return f"lpad(cast({key} as string), greatest({width}, length(cast({key} as string))), '0')"


def _card_of(key: str) -> str:
    return f"concat('4', {_wide(key, 15)})"


_NATION = ("nation", "c_nationkey = n_nationkey")
_REGION = ("region", "n_regionkey = r_regionkey")
_CUSTOMER = ("customer", "o_custkey = c_custkey")

_RAW_CUSTOMER = {
    "SSN": "c_custkey",
    "FIRST_NAME": "c_mktsegment",
    "MIDDLE_NAME": "upper(n_name)",
    "LAST_NAME": "upper(c_name)",
    "CREDIT_CARD_NO": _card_of("c_custkey"),
    "STREET_NAME": "case when c_acctbal >= 0 then n_name end",
    "APT_NO": "case when c_mktsegment <> 'BUILDING' then cast(c_custkey as string) end",
    "CUST_CITY": "n_name",
    "CUST_STATE": "n_name",
    "CUST_COUNTRY": "r_name",
    "CUST_ZIP": "case when c_mktsegment <> 'MACHINERY' then 1000 + c_nationkey end",
    "CUST_PHONE": "case when c_mktsegment = 'AUTOMOBILE' then cast(c_custkey as string)"
    f" else concat('123', {_wide('c_custkey', 7)}) end",
    "CUST_EMAIL": "concat('c', cast(c_custkey as string), '@example.com')",
    "LAST_UPDATED": _UPDATED,
}

_RAW_BRANCH = {
    "BRANCH_CODE": "s_suppkey",
    "BRANCH_NAME": "s_name",
    "BRANCH_STREET": "concat(n_name, ' Street')",
    "BRANCH_CITY": "n_name",
    "BRANCH_STATE": "n_name",
    "BRANCH_ZIP": "case when s_acctbal >= 0 then 2000 + s_nationkey end",
    "BRANCH_PHONE": f"concat('123', {_wide('s_suppkey', 7)})",
    "LAST_UPDATED": _UPDATED,
}

_RAW_CARD = {
    "CREDIT_CARD_NO": _card_of("o_custkey"),
    "YEAR": "year(o_orderdate)",
    "MONTH": "month(o_orderdate)",
    "DAY": "day(o_orderdate)",
    "CUST_SSN": "o_custkey",
    "BRANCH_CODE": "cast(null as bigint)",
    "TRANSACTION_TYPE": "o_orderpriority",
    "TRANSACTION_VALUE": "cast(o_totalprice as decimal(18,2))",
    "TRANSACTION_ID": "o_orderkey",
}

_CARD = {
    "CUST_CC_NO": _RAW_CARD["CREDIT_CARD_NO"],
    "TIMEID": "date_format(o_orderdate, 'yyyyMMdd')",
    "TXN_DATE": "cast(o_orderdate as date)",
    **{name: _RAW_CARD[name] for name in
       ("CUST_SSN", "BRANCH_CODE", "TRANSACTION_TYPE", "TRANSACTION_VALUE", "TRANSACTION_ID")},
}

_TXN = {
    "CUST_CC_NO": _card_of("o_custkey"),
    "TIMEID": "date_format(l_shipdate, 'yyyyMMdd')",
    "TXN_DATE": "cast(l_shipdate as date)",
    "CUST_SSN": "o_custkey",
    "BRANCH_CODE": "l_suppkey",
    "TRANSACTION_TYPE": "p_type",
    "TRANSACTION_VALUE": "cast(l_extendedprice as decimal(18,2))",
}

_RAW_LOAN = {
    "Application_ID": f"concat('LP', {_wide('o_orderkey', 12)})",
    "Gender": "case when c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'MACHINERY') then 'Male' else 'Female' end",
    "Married": "case when r_name in ('AFRICA', 'EUROPE') then 'No' else 'Yes' end",
    "Dependents": "substr(o_orderpriority, 1, 1)",
    "Education": "case when c_mktsegment = 'BUILDING' then 'Not Graduate' else 'Graduate' end",
    "Self_Employed": "case when o_orderpriority = '1-URGENT' then 'Yes' else 'No' end",
    "Credit_History": "case when o_totalprice >= 250000 then '1' else '0' end",
    "Property_Area": "r_name",
    "Income": "case when c_acctbal < 3000 then 'low' when c_acctbal < 6000 then 'medium' else 'high' end",
    "Application_Status": "case when o_orderstatus = 'F' then 'Y' else 'N' end",
}

# One record per order line: several per key, some without key, some with text
# that is too long or not a number.
_LOAN_FEED = {
    **{name: name for name in _RAW_LOAN},
    "Application_ID": "case when l_discount > 0 or l_tax > 0 then Application_ID end",
    "Dependents": "o_orderpriority",
    "Credit_History": "case when l_returnflag = 'R' and l_linestatus = 'F' then 'unknown'"
    " when l_returnflag = 'A' then '1' else '0' end",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _view(spark, sf_dir, fact, lookups, columns, wanted=()) -> DataFrame:
    chosen = {name: columns[name] for name in wanted or columns}
    used = " ".join(chosen.values())
    needed = []
    for name, on in reversed(lookups):
        if re.search(rf"\b{name[0]}_", used):
            needed.insert(0, (name, on))
            used += " " + on
    df = table(spark, sf_dir, fact)
    for name, on in needed:
        df = df.join(table(spark, sf_dir, name), F.expr(on), "left")
    return df.selectExpr(*[f"{text} AS {name}" for name, text in chosen.items()])


def raw_customer(spark, sf_dir, *wanted: str) -> DataFrame:
    return _view(spark, sf_dir, "customer", [_NATION, _REGION], _RAW_CUSTOMER, wanted)


def raw_branch(spark, sf_dir, *wanted: str) -> DataFrame:
    return _view(spark, sf_dir, "supplier", [("nation", "s_nationkey = n_nationkey")], _RAW_BRANCH, wanted)


def raw_card(spark, sf_dir, *wanted: str) -> DataFrame:
    return _view(spark, sf_dir, "orders", [], _RAW_CARD, wanted)


def raw_loan(spark, sf_dir, *wanted: str) -> DataFrame:
    return _view(spark, sf_dir, "orders", [_CUSTOMER, _NATION, _REGION], _RAW_LOAN, wanted)


def loan_feed(spark, sf_dir, *wanted: str) -> DataFrame:
    """Order lines with their loan; the lookups are made per order, so lines shuffle once."""
    chosen = {name: _LOAN_FEED[name] for name in wanted or _LOAN_FEED}
    used = [name for name in _RAW_LOAN if re.search(rf"\b{name}\b", " ".join(chosen.values()))]
    kept = {name: name for name in ("o_orderkey", "o_orderpriority")}
    columns = {**{name: _RAW_LOAN[name] for name in used}, **kept}
    loans = _view(spark, sf_dir, "orders", [_CUSTOMER, _NATION, _REGION], columns)
    lines = table(spark, sf_dir, "lineitem").join(loans, F.expr("l_orderkey = o_orderkey"), "left")
    return lines.selectExpr(*[f"{text} AS {name}" for name, text in chosen.items()])


# Deliveries as text, with the defects that rules must find. One customer record
# per order: keys repeat, pass INT and are partly spelt as decimals, some ZIP
# codes are too long, some times are in another format.
_CUSTOMER_FEED = {
    **_RAW_CUSTOMER,
    "SSN": "concat(cast(3000000000 + c_custkey as string), case when o_orderpriority = '1-URGENT' then '.0' else '' end)",
    "CUST_ZIP": "case when o_orderstatus = 'P' then concat(cast(1000 + c_nationkey as string), '1234')"
    " when c_mktsegment <> 'MACHINERY' then cast(1000 + c_nationkey as string) end",
    "LAST_UPDATED": "date_format(o_orderdate, case when o_orderpriority = '5-LOW' then 'dd.MM.yyyy' else 'yyyy-MM-dd HH:mm:ss' end)",
}

# Branch records with wide keys spelt as decimals.
_BRANCH_FEED = {
    **_RAW_BRANCH,
    "BRANCH_CODE": "concat(cast(3000000000 + s_suppkey as string), '.0')",
    "BRANCH_ZIP": "case when s_acctbal >= 0 then cast(2000 + s_nationkey as string) end",
    "LAST_UPDATED": "'2021-09-30 07:15:44'",
}

# Transactions on the 31st of any month, with a third decimal, without a card.
_CARD_FEED = {
    **_RAW_CARD,
    "CREDIT_CARD_NO": f"case when o_totalprice >= 5000 then {_RAW_CARD['CREDIT_CARD_NO']} end",
    "DAY": "case when o_orderpriority = '1-URGENT' then '31' else cast(day(o_orderdate) as string) end",
    "CUST_SSN": "cast(3000000000 + o_custkey as string)",
    "TRANSACTION_VALUE": "concat(cast(cast(o_totalprice as decimal(18,2)) as string), case when o_orderstatus = 'P' then '5' else '0' end)",
}


def customer_feed(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, "orders", [_CUSTOMER, _NATION, _REGION], _CUSTOMER_FEED)


def txn_feed(spark, sf_dir) -> DataFrame:
    """Delivered transactions with branch and type (order lines), as text; ``ordered`` is the day of the order."""
    lookups = [("orders", "l_orderkey = o_orderkey"), ("part", "l_partkey = p_partkey")]
    columns = {
        "CREDIT_CARD_NO": _TXN["CUST_CC_NO"],
        **{part: f"cast({part.lower()}(l_shipdate) as string)" for part in ("YEAR", "MONTH", "DAY")},
        **{name: f"cast({_TXN[name]} as string)" for name in ("CUST_SSN", "BRANCH_CODE", "TRANSACTION_TYPE", "TRANSACTION_VALUE")},
        "TRANSACTION_ID": "concat(cast(l_orderkey as string), lpad(cast(l_linenumber as string), 2, '0'))",
        "ordered": "o_orderdate",
    }
    return _view(spark, sf_dir, "lineitem", lookups, columns)


def branch_feed(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, "supplier", [("nation", "s_nationkey = n_nationkey")], _BRANCH_FEED)


def card_feed(spark, sf_dir) -> DataFrame:
    return _view(spark, sf_dir, "orders", [], _CARD_FEED)


def earlier_loans(spark, sf_dir) -> DataFrame:
    """An earlier delivery of loans: the applications made before 1998, without defects."""
    kept = {**_RAW_LOAN, "made": "o_orderdate"}
    loans = _view(spark, sf_dir, "orders", [_CUSTOMER, _NATION, _REGION], kept)
    return loans.where("made < timestamp_ntz'1998-01-01'").drop("made")


def customer(spark, sf_dir) -> DataFrame:
    return clean.clean_customer(raw_customer(spark, sf_dir))


def branch(spark, sf_dir) -> DataFrame:
    return clean.clean_branch(raw_branch(spark, sf_dir))


def card(spark, sf_dir) -> DataFrame:
    """Stored transactions with an id (orders)."""
    return _view(spark, sf_dir, "orders", [], _CARD)


def txn(spark, sf_dir, *wanted: str) -> DataFrame:
    """Stored transactions with branch and type (order lines)."""
    lookups = [("orders", "l_orderkey = o_orderkey"), ("part", "l_partkey = p_partkey")]
    return _view(spark, sf_dir, "lineitem", lookups, _TXN, wanted)


def customer_sums(spark, sf_dir) -> DataFrame:
    """``txn`` for totals per customer: an order's lines are summed before the
    customer is looked up, so an order with very many lines shuffles as few rows."""
    per_order = txn_lines(spark, sf_dir, "l_orderkey", "TRANSACTION_VALUE").groupBy("l_orderkey").agg(
        F.sum("TRANSACTION_VALUE").alias("TRANSACTION_VALUE")
    )
    return _with_order(spark, sf_dir, per_order, "CUST_SSN").select("CUST_SSN", "TRANSACTION_VALUE")


def shipped_months(spark, sf_dir) -> DataFrame:
    """Card and month of every order line, each once per order.

    An order's months are gathered as a set, so the lines shuffle by order only,
    once for the set and the lookup.
    """
    month = F.struct(F.year("TXN_DATE").alias("YEAR"), F.month("TXN_DATE").alias("MONTH"))
    months = txn_lines(spark, sf_dir, "l_orderkey", "TXN_DATE").groupBy("l_orderkey").agg(F.collect_set(month).alias("months"))
    return _with_order(spark, sf_dir, months, "CUST_CC_NO").select("CUST_CC_NO", F.inline("months"))


def txn_lines(spark, sf_dir, *wanted: str) -> DataFrame:
    return _view(spark, sf_dir, "lineitem", [], {**_TXN, "l_orderkey": "l_orderkey"}, wanted)


def _with_order(spark, sf_dir, lines: DataFrame, column: str) -> DataFrame:
    orders = _view(spark, sf_dir, "orders", [], {"o_orderkey": "o_orderkey", column: _TXN[column]})
    return lines.join(orders, F.expr("l_orderkey = o_orderkey"), "left")


def loan(spark, sf_dir, *wanted: str) -> DataFrame:
    if wanted:
        return raw_loan(spark, sf_dir, *wanted)
    return quality.as_stored_loan(raw_loan(spark, sf_dir))


def event_cards(spark, sf_dir) -> DataFrame:
    """The card of every event's customer, once per event."""
    return table(spark, sf_dir, "events").selectExpr(f"{_card_of('user_id')} AS CUST_CC_NO")


def email_requests(spark, sf_dir) -> DataFrame:
    """One change request per event; the user is the customer."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("SSN"),
        F.col("ts").alias("REQUESTED_AT"),
        F.concat(F.lit("u"), F.col("event_id").cast("string"), F.lit("@example.com")).alias("CUST_EMAIL"),
    )


def part_requests(spark, sf_dir) -> DataFrame:
    """Change requests that name part numbers as customers; the higher ones belong to nobody."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("SSN"), F.concat(F.col("p_name"), F.lit("@example.com")).alias("CUST_EMAIL")
    )


def stored_loan_keys(spark, sf_dir) -> DataFrame:
    """Keys of an earlier load: the applications made before 1998."""
    earlier = table(spark, sf_dir, "orders").where("o_orderdate < timestamp_ntz'1998-01-01'")
    return earlier.selectExpr(f"{_RAW_LOAN['Application_ID']} AS Application_ID")
