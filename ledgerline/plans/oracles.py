"""The registered queries as DuckDB SQL over the supplied tables."""

from __future__ import annotations

# Views, each as (name, views it reads, text).
_VIEWS = {
    "raw_customer": ((), """
        SELECT c_custkey AS SSN, c_mktsegment AS FIRST_NAME, upper(n_name) AS MIDDLE_NAME, upper(c_name) AS LAST_NAME,
               '4' || repeat('0', greatest(0, 15 - length(CAST(c_custkey AS VARCHAR)))) || CAST(c_custkey AS VARCHAR) AS CREDIT_CARD_NO,
               CASE WHEN c_acctbal >= 0 THEN n_name END AS STREET_NAME,
               CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_custkey AS VARCHAR) END AS APT_NO,
               n_name AS CUST_CITY, n_name AS CUST_STATE, r_name AS CUST_COUNTRY,
               CAST(CASE WHEN c_mktsegment <> 'MACHINERY' THEN 1000 + c_nationkey END AS INT) AS CUST_ZIP,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(c_custkey AS VARCHAR)
                    ELSE '123' || repeat('0', greatest(0, 7 - length(CAST(c_custkey AS VARCHAR)))) || CAST(c_custkey AS VARCHAR) END AS CUST_PHONE,
               'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS CUST_EMAIL,
               '2021-09-30 07:15:44' AS LAST_UPDATED
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "raw_branch": ((), """
        SELECT s_suppkey AS BRANCH_CODE, s_name AS BRANCH_NAME, n_name || ' Street' AS BRANCH_STREET,
               n_name AS BRANCH_CITY, n_name AS BRANCH_STATE,
               CAST(CASE WHEN s_acctbal >= 0 THEN 2000 + s_nationkey END AS INT) AS BRANCH_ZIP,
               '123' || repeat('0', greatest(0, 7 - length(CAST(s_suppkey AS VARCHAR)))) || CAST(s_suppkey AS VARCHAR) AS BRANCH_PHONE,
               '2021-09-30 07:15:44' AS LAST_UPDATED
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""),
    "raw_card": ((), """
        SELECT '4' || repeat('0', greatest(0, 15 - length(CAST(o_custkey AS VARCHAR)))) || CAST(o_custkey AS VARCHAR) AS CREDIT_CARD_NO,
               CAST(year(o_orderdate) AS INT) AS "YEAR", CAST(month(o_orderdate) AS INT) AS "MONTH",
               CAST(day(o_orderdate) AS INT) AS "DAY",
               o_custkey AS CUST_SSN, CAST(NULL AS BIGINT) AS BRANCH_CODE, o_orderpriority AS TRANSACTION_TYPE,
               CAST(o_totalprice AS DECIMAL(18,2)) AS TRANSACTION_VALUE, o_orderkey AS TRANSACTION_ID
        FROM orders"""),
    "raw_loan": ((), """
        SELECT 'LP' || repeat('0', greatest(0, 12 - length(CAST(o_orderkey AS VARCHAR)))) || CAST(o_orderkey AS VARCHAR) AS Application_ID,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 'Male' ELSE 'Female' END AS Gender,
               CASE WHEN r_name IN ('AFRICA', 'EUROPE') THEN 'No' ELSE 'Yes' END AS Married,
               substr(o_orderpriority, 1, 1) AS Dependents,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Not Graduate' ELSE 'Graduate' END AS Education,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' ELSE 'No' END AS Self_Employed,
               CASE WHEN o_totalprice >= 250000 THEN '1' ELSE '0' END AS Credit_History,
               r_name AS Property_Area,
               CASE WHEN c_acctbal < 3000 THEN 'low' WHEN c_acctbal < 6000 THEN 'medium' ELSE 'high' END AS Income,
               CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS Application_Status
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
             LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "loan_feed": (("raw_loan",), """
        SELECT CASE WHEN l_discount > 0 OR l_tax > 0 THEN Application_ID END AS Application_ID,
               Gender, Married, o_orderpriority AS Dependents, Education, Self_Employed,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'unknown'
                    WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS Credit_History,
               Property_Area, Income, Application_Status
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
             LEFT JOIN raw_loan ON Application_ID = 'LP' || repeat('0', greatest(0, 12 - length(CAST(l_orderkey AS VARCHAR)))) || CAST(l_orderkey AS VARCHAR)"""),
    "flagged": (("loan_feed",), """
        SELECT *, CASE WHEN Application_ID IS NULL THEN 'missing:Application_ID'
                       WHEN length(Application_ID) > 20 THEN 'too_long:Application_ID'
                       WHEN length(Gender) > 10 THEN 'too_long:Gender'
                       WHEN length(Married) > 10 THEN 'too_long:Married'
                       WHEN length(Dependents) > 10 THEN 'too_long:Dependents'
                       WHEN length(Education) > 20 THEN 'too_long:Education'
                       WHEN length(Self_Employed) > 10 THEN 'too_long:Self_Employed'
                       WHEN length(Property_Area) > 20 THEN 'too_long:Property_Area'
                       WHEN length(Income) > 20 THEN 'too_long:Income'
                       WHEN length(Application_Status) > 10 THEN 'too_long:Application_Status'
                       WHEN Credit_History IS NOT NULL AND TRY_CAST(Credit_History AS INT) IS NULL THEN 'not_whole:Credit_History'
                  END AS reject_reason
        FROM loan_feed"""),
    "sound": (("flagged",), """
        SELECT * EXCLUDE (reject_reason), row_number() OVER (
                 PARTITION BY Application_ID
                 ORDER BY Gender NULLS FIRST, Married NULLS FIRST, Dependents NULLS FIRST, Education NULLS FIRST,
                          Self_Employed NULLS FIRST, Credit_History NULLS FIRST, Property_Area NULLS FIRST,
                          Income NULLS FIRST, Application_Status NULLS FIRST) AS rn
        FROM flagged WHERE reject_reason IS NULL"""),
    "customer_v": (("raw_customer",), """
        SELECT SSN, upper(substr(FIRST_NAME, 1, 1)) || lower(substr(FIRST_NAME, 2)) AS FIRST_NAME,
               lower(MIDDLE_NAME) AS MIDDLE_NAME,
               upper(substr(LAST_NAME, 1, 1)) || lower(substr(LAST_NAME, 2)) AS LAST_NAME,
               CREDIT_CARD_NO AS Credit_card_no, concat_ws(', ', APT_NO, STREET_NAME) AS FULL_STREET_ADDRESS,
               CUST_CITY, CUST_STATE, CUST_COUNTRY, coalesce(CUST_ZIP, 99999) AS CUST_ZIP,
               repeat('0', greatest(0, 5 - length(CAST(coalesce(CUST_ZIP, 99999) AS VARCHAR)))) || CAST(coalesce(CUST_ZIP, 99999) AS VARCHAR) AS CUST_ZIP5,
               CASE WHEN regexp_matches(CUST_PHONE, '^[0-9]{10}$')
                    THEN '(' || substr(CUST_PHONE, 1, 3) || ')' || substr(CUST_PHONE, 4, 3) || '-' || substr(CUST_PHONE, 7, 4)
                    ELSE CUST_PHONE END AS CUST_PHONE,
               CUST_EMAIL, LAST_UPDATED
        FROM raw_customer"""),
    "branch_v": (("raw_branch",), """
        SELECT BRANCH_CODE, BRANCH_NAME, BRANCH_STREET, BRANCH_CITY, BRANCH_STATE,
               coalesce(BRANCH_ZIP, 99999) AS BRANCH_ZIP,
               repeat('0', greatest(0, 5 - length(CAST(coalesce(BRANCH_ZIP, 99999) AS VARCHAR)))) || CAST(coalesce(BRANCH_ZIP, 99999) AS VARCHAR) AS BRANCH_ZIP5,
               CASE WHEN regexp_matches(BRANCH_PHONE, '^[0-9]{10}$')
                    THEN '(' || substr(BRANCH_PHONE, 1, 3) || ')' || substr(BRANCH_PHONE, 4, 3) || '-' || substr(BRANCH_PHONE, 7, 4)
                    ELSE BRANCH_PHONE END AS BRANCH_PHONE,
               LAST_UPDATED
        FROM raw_branch"""),
    "card": (("raw_card",), """
        SELECT CREDIT_CARD_NO AS CUST_CC_NO, strftime(make_date("YEAR", "MONTH", "DAY"), '%Y%m%d') AS TIMEID,
               make_date("YEAR", "MONTH", "DAY") AS TXN_DATE, CUST_SSN, BRANCH_CODE, TRANSACTION_TYPE,
               TRANSACTION_VALUE, TRANSACTION_ID
        FROM raw_card"""),
    "txn": ((), """
        SELECT '4' || repeat('0', greatest(0, 15 - length(CAST(o_custkey AS VARCHAR)))) || CAST(o_custkey AS VARCHAR) AS CUST_CC_NO, CAST(l_shipdate AS DATE) AS TXN_DATE,
               o_custkey AS CUST_SSN, l_suppkey AS BRANCH_CODE, p_type AS TRANSACTION_TYPE,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS TRANSACTION_VALUE
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey"""),
    "customer_feed": ((), """
        SELECT o_custkey AS SSN, o_orderstatus = 'P' AS long_zip,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS updated
        FROM orders"""),
    "card_flagged": (("raw_card",), """
        SELECT *, TRY_CAST(printf('%04d-%02d-%02d', "YEAR", "MONTH", CAST(day_text AS INT)) AS DATE) AS d,
               CASE WHEN CREDIT_CARD_NO IS NULL THEN 'missing:CREDIT_CARD_NO'
                    WHEN right(value_text, 1) <> '0' THEN 'not_money:TRANSACTION_VALUE'
                    WHEN TRY_CAST(printf('%04d-%02d-%02d', "YEAR", "MONTH", CAST(day_text AS INT)) AS DATE) IS NULL
                    THEN 'no_date:YEAR-MONTH-DAY' END AS reject_reason
        FROM (SELECT r.* REPLACE (CASE WHEN o_totalprice >= 5000 THEN CREDIT_CARD_NO END AS CREDIT_CARD_NO,
                                  3000000000 + CUST_SSN AS CUST_SSN),
                     CASE WHEN o_orderpriority = '1-URGENT' THEN '31' ELSE CAST("DAY" AS VARCHAR) END AS day_text,
                     CAST(TRANSACTION_VALUE AS VARCHAR) || CASE WHEN o_orderstatus = 'P' THEN '5' ELSE '0' END AS value_text
              FROM raw_card r JOIN orders ON o_orderkey = TRANSACTION_ID)"""),
    "loan": (("raw_loan",), "SELECT * REPLACE (CAST(Credit_History AS INT) AS Credit_History) FROM raw_loan"),
    "stored": ((), """
        SELECT 'LP' || repeat('0', greatest(0, 12 - length(CAST(o_orderkey AS VARCHAR)))) || CAST(o_orderkey AS VARCHAR) AS Application_ID
        FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"""),
    "email_requests": ((), """
        SELECT user_id AS SSN, ts AS REQUESTED_AT, 'u' || CAST(event_id AS VARCHAR) || '@example.com' AS CUST_EMAIL
        FROM events"""),
}

_LOAN = (
    "Application_ID, Gender, Married, Dependents, Education, Self_Employed, "
    "Credit_History, Property_Area, Income, Application_Status"
)
_STORED_LOAN = _LOAN.replace("Credit_History", "CAST(Credit_History AS INT) AS Credit_History")
_CARD = (
    "CUST_CC_NO, TIMEID, CAST(TXN_DATE AS VARCHAR) AS TXN_DATE, CUST_SSN, BRANCH_CODE, TRANSACTION_TYPE, "
    "CAST(TRANSACTION_VALUE AS DOUBLE) AS TRANSACTION_VALUE, TRANSACTION_ID"
)
_STORED_CARD = (
    f"{_CARD}, lower(TRANSACTION_TYPE) AS TRANSACTION_TYPE_KEY, "
    "CAST(year(card.TXN_DATE) AS INT) AS TXN_YEAR, CAST(month(card.TXN_DATE) AS INT) AS TXN_MONTH"
)
_CUSTOMER_LOAD = """
        SELECT c.* REPLACE (3000000000 + c.SSN AS SSN, CAST(f.updated AS VARCHAR) AS LAST_UPDATED)
        FROM customer_v c JOIN (SELECT SSN, max(updated) AS updated FROM customer_feed WHERE NOT long_zip GROUP BY SSN) f
        ON c.SSN = f.SSN"""
_SUM = "CAST(sum(TRANSACTION_VALUE) AS DOUBLE) AS TOTAL_VALUE"
_SEGMENTS = "Gender, Married, Education, Self_Employed, Property_Area"


def _pct(part: str, of: str, digits: int = 4) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100 / nullif(CAST({of} AS DOUBLE), 0), {digits})"


def _label(part: str, of: str) -> str:
    return f"CAST(CAST({_pct(part, of, 1)} AS DECIMAL(18,1)) AS VARCHAR) || '%'"


def _segment_rates(columns: str, grouping: str) -> str:
    flags = ", ".join(f"CAST(1 - grouping({c}) AS INT) AS IN_{c}" for c in columns.split(", "))
    approved = "count(*) FILTER (WHERE Application_Status = 'Y')"
    return (
        f"SELECT {columns}, {flags}, count(*) AS APPLICATIONS, {approved} AS APPROVED, "
        f"{_pct(approved, 'count(*)')} AS PCT FROM loan GROUP BY {grouping}({columns})"
    )


def _approval_rate(counted: str) -> str:
    approved = f"count(*) FILTER (WHERE {counted})"
    self_employed = "count(*) FILTER (WHERE Self_Employed = 'Yes')"
    return (
        f"SELECT count(*) AS TOTAL, {approved} AS APPROVED, {self_employed} AS SELF_EMPLOYED, "
        f"{_pct(approved, self_employed)} AS PCT FROM loan"
    )


_LEADERS = "SELECT * FROM g WHERE {m} = (SELECT max({m}) FROM g)"

_TOP_CUSTOMERS = f"SELECT CUST_SSN, sum(TRANSACTION_VALUE) AS v FROM txn GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
_TOP_CUSTOMER_COLUMNS = (
    "CUST_SSN, CAST(v AS DOUBLE) AS TOTAL_VALUE, "
    "CAST(CUST_SSN AS VARCHAR) || ' ($' || CAST(CAST(v AS DECIMAL(38,2)) AS VARCHAR) || ')' AS LABEL"
)
_TOP_MONTHS = (
    'SELECT CAST(year(TXN_DATE) AS INT) AS "YEAR", CAST(month(TXN_DATE) AS INT) AS "MONTH", count(*) AS TXN_COUNT '
    "FROM txn WHERE TXN_DATE IS NOT NULL GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 3"
)
_MONTH_COLUMNS = (
    '"YEAR", "MONTH", TXN_COUNT, CAST("YEAR" AS VARCHAR) || \'-\' || lpad(CAST("MONTH" AS VARCHAR), 2, \'0\') AS LABEL'
)

_SPLIT = """
    WITH r AS (SELECT count(*) AS t, count(*) FILTER (WHERE Application_Status = 'N') AS n
               FROM loan WHERE Gender = 'Male' AND Married = 'Yes'),
         s AS (SELECT 'Approved' AS STATUS, t - n AS APPLICATIONS, t FROM r
               UNION ALL SELECT 'Rejected', n, t FROM r)
    SELECT STATUS, APPLICATIONS, {pct} AS PCT, {label} AS PCT_LABEL FROM s""".format(
    pct=_pct("APPLICATIONS", "t"), label=_label("APPLICATIONS", "t")
)

# Query name -> (views it reads, text).
_QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "scan_json_branch": (("raw_branch",), "SELECT * FROM raw_branch"),
    "scan_json_customer": (("raw_customer",), "SELECT * FROM raw_customer"),
    "scan_json_transaction": (
        ("raw_card",),
        "SELECT * REPLACE (CAST(TRANSACTION_VALUE AS DOUBLE) AS TRANSACTION_VALUE) FROM raw_card",
    ),
    "scan_json_array_loan": (("raw_loan",), f"SELECT {_LOAN} FROM raw_loan"),
    "transaction_load": (
        ("card",),
        f"SELECT {_STORED_CARD} FROM card",
    ),
    "scan_json_multi_line_loan": (("raw_loan",), f"SELECT {_LOAN} FROM raw_loan"),
    "branch_load": (("branch_v",), "SELECT * REPLACE (3000000000 + BRANCH_CODE AS BRANCH_CODE) FROM branch_v"),
    "customer_load": (("customer_v", "customer_feed"), _CUSTOMER_LOAD),
    "customer_lookup_repeated": (("customer_v", "customer_feed"), f"SELECT * FROM ({_CUSTOMER_LOAD}) WHERE SSN = 3000000007"),
    "card_load": (("card_flagged",), """
        SELECT CREDIT_CARD_NO AS CUST_CC_NO, strftime(d, '%Y%m%d') AS TIMEID, CAST(d AS VARCHAR) AS TXN_DATE, CUST_SSN,
               BRANCH_CODE, TRANSACTION_TYPE, CAST(TRANSACTION_VALUE AS DOUBLE) AS TRANSACTION_VALUE, TRANSACTION_ID,
               lower(TRANSACTION_TYPE) AS TRANSACTION_TYPE_KEY, CAST(year(d) AS INT) AS TXN_YEAR,
               CAST(month(d) AS INT) AS TXN_MONTH
        FROM card_flagged WHERE reject_reason IS NULL"""),
    "card_load_rejects": (("card_flagged",), """
        SELECT CREDIT_CARD_NO, CAST("YEAR" AS VARCHAR) AS "YEAR", CAST("MONTH" AS VARCHAR) AS "MONTH", day_text AS "DAY",
               CAST(CUST_SSN AS VARCHAR) AS CUST_SSN, CAST(NULL AS VARCHAR) AS BRANCH_CODE, TRANSACTION_TYPE,
               value_text AS TRANSACTION_VALUE, CAST(TRANSACTION_ID AS VARCHAR) AS TRANSACTION_ID, reject_reason,
               CAST(1 AS BIGINT) AS copies
        FROM card_flagged WHERE reject_reason IS NOT NULL"""),
    "bank_load_report": (("customer_feed", "card_flagged"), """
        WITH b AS (SELECT count(*) AS n FROM supplier),
             c AS (SELECT count(*) AS n, count(*) FILTER (WHERE long_zip) AS bad,
                          count(DISTINCT SSN) FILTER (WHERE NOT long_zip) AS one FROM customer_feed),
             t AS (SELECT count(*) AS n, count(*) FILTER (WHERE reject_reason IS NULL) AS good FROM card_flagged),
             r AS (SELECT 'branch' AS "table", 'read' AS outcome, n AS "rows" FROM b
                   UNION ALL SELECT 'branch', 'accepted', n FROM b
                   UNION ALL SELECT 'customer', 'read', n FROM c
                   UNION ALL SELECT 'customer', 'accepted', one FROM c
                   UNION ALL SELECT 'customer', 'duplicate_key', n - bad - one FROM c
                   UNION ALL SELECT 'customer', 'too_long:CUST_ZIP', bad FROM c
                   UNION ALL SELECT 'transaction', 'read', n FROM t
                   UNION ALL SELECT 'transaction', 'accepted', good FROM t
                   UNION ALL SELECT 'transaction', reject_reason, count(*) FROM card_flagged
                             WHERE reject_reason IS NOT NULL GROUP BY 2)
        SELECT * FROM r WHERE "rows" > 0 OR outcome IN ('read', 'accepted')"""),
    "top_months_stored": (("card",), f"WITH m AS ({_TOP_MONTHS.replace('FROM txn', 'FROM card')}) SELECT {_MONTH_COLUMNS} FROM m"),
    "customer_txn_between_stored": (("card",), f"""
        SELECT {_STORED_CARD} FROM card
        WHERE CUST_SSN = 7 AND card.TXN_DATE BETWEEN DATE '1996-12-01' AND DATE '1999-02-28'"""),
    "type_total_any_case_stored": (("card",), f"""
        SELECT count(*) AS TXN_COUNT, {_SUM} FROM card WHERE lower(TRANSACTION_TYPE) = '1-urgent'"""),
    "load_report": (("sound",), """
        SELECT 'read' AS outcome, count(*) AS "rows" FROM flagged
        UNION ALL SELECT 'accepted', count(*) FROM sound WHERE rn = 1
        UNION ALL SELECT 'duplicate_key', count(*) FROM sound WHERE rn > 1
        UNION ALL SELECT reject_reason, count(*) FROM flagged WHERE reject_reason IS NOT NULL GROUP BY 1"""),
    "loan_load": (("sound", "raw_loan", "stored"), f"""
        SELECT {_STORED_LOAN} FROM raw_loan WHERE Application_ID IN (SELECT Application_ID FROM stored)
        UNION ALL
        SELECT {_STORED_LOAN} FROM sound WHERE rn = 1 AND Application_ID NOT IN (SELECT Application_ID FROM stored)"""),
    "loan_load_report": (("sound", "stored"), """
        SELECT 'read' AS outcome, count(*) AS "rows" FROM flagged
        UNION ALL SELECT 'accepted', count(*) FROM sound
            WHERE rn = 1 AND Application_ID NOT IN (SELECT Application_ID FROM stored)
        UNION ALL SELECT 'already_stored', count(*) FROM sound
            WHERE rn = 1 AND Application_ID IN (SELECT Application_ID FROM stored)
        UNION ALL SELECT 'duplicate_key', count(*) FROM sound WHERE rn > 1
        UNION ALL SELECT reject_reason, count(*) FROM flagged WHERE reject_reason IS NOT NULL GROUP BY 1"""),
    "loan_accepted": (("sound",), f"SELECT {_STORED_LOAN} FROM sound WHERE rn = 1"),
    "loan_rejects": (("sound",), f"""
        SELECT {_LOAN}, reject_reason, count(*) AS copies FROM flagged WHERE reject_reason IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT {_LOAN}, 'duplicate_key', count(*) FROM sound WHERE rn > 1 GROUP BY ALL"""),
    "loan_duplicate_keys": (
        ("loan_feed",),
        "SELECT Application_ID, count(*) AS copies FROM loan_feed WHERE Application_ID IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    ),
    "loan_new_only": (
        ("raw_loan", "stored"),
        f"SELECT {_LOAN} FROM raw_loan WHERE Application_ID NOT IN (SELECT Application_ID FROM stored)",
    ),
    "loan_already_stored": (
        ("raw_loan", "stored"),
        f"SELECT {_LOAN} FROM raw_loan WHERE Application_ID IN (SELECT Application_ID FROM stored)",
    ),
    "loan_full_scan": (("loan",), "SELECT * FROM loan"),
    "branch_clean": (("branch_v",), "SELECT * FROM branch_v"),
    "customer_clean": (("customer_v",), "SELECT * FROM customer_v"),
    "transaction_clean": (("card",), f"SELECT {_CARD} FROM card"),
    "zip_default": (("raw_customer",), """
        SELECT SSN, CUST_ZIP, coalesce(CUST_ZIP, 99999) AS ZIP,
               repeat('0', greatest(0, 5 - length(CAST(coalesce(CUST_ZIP, 99999) AS VARCHAR)))) || CAST(coalesce(CUST_ZIP, 99999) AS VARCHAR) AS ZIP5 FROM raw_customer"""),
    "phone_format": (
        ("raw_customer", "customer_v"),
        "SELECT SSN, r.CUST_PHONE, c.CUST_PHONE AS PHONE FROM raw_customer r JOIN customer_v c USING (SSN)",
    ),
    "address_join": (
        ("raw_customer",),
        "SELECT SSN, APT_NO, STREET_NAME, concat_ws(', ', APT_NO, STREET_NAME) AS ADDRESS FROM raw_customer",
    ),
    "name_case": (("raw_customer",), """
        SELECT SSN, FIRST_NAME, MIDDLE_NAME, upper(substr(FIRST_NAME, 1, 1)) || lower(substr(FIRST_NAME, 2)) AS TITLE_CASE,
               lower(MIDDLE_NAME) AS LOWER_CASE FROM raw_customer"""),
    "timeid_key": (("raw_card",), """
        SELECT TRANSACTION_ID, "YEAR", "MONTH", "DAY", CAST(make_date("YEAR", "MONTH", "DAY") AS VARCHAR) AS TXN_DATE,
               strftime(make_date("YEAR", "MONTH", "DAY"), '%Y%m%d') AS TIMEID FROM raw_card"""),
    "customer_email_upsert": (("customer_v", "email_requests"), """
        SELECT c.* REPLACE (coalesce(n.CUST_EMAIL, c.CUST_EMAIL) AS CUST_EMAIL)
        FROM customer_v c LEFT JOIN (
            SELECT SSN, CUST_EMAIL FROM email_requests
            QUALIFY row_number() OVER (PARTITION BY SSN ORDER BY REQUESTED_AT DESC, CUST_EMAIL DESC) = 1) n
        ON c.SSN = n.SSN"""),
    "email_requests_unmatched": (
        (),
        "SELECT DISTINCT p_partkey AS SSN FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)",
    ),
    "customer_lookup": (("customer_v",), "SELECT * FROM customer_v WHERE SSN = 7"),
    "customer_lookup_bulk": (
        ("customer_v", "email_requests"),
        "SELECT * FROM customer_v WHERE SSN IN (SELECT SSN FROM email_requests)",
    ),
    "lookup_unmatched_keys": ((), """
        SELECT DISTINCT l_partkey AS SSN FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)"""),
    "monthly_bill": (("card",), f"""
        SELECT {_CARD} FROM card
        WHERE year(card.TXN_DATE) = 1995 AND month(card.TXN_DATE) = 10 AND CUST_CC_NO = '4000000000000007'"""),
    "monthly_bill_run": (("card",), f"""
        SELECT {_CARD} FROM card
        WHERE year(card.TXN_DATE) = 1998 AND month(card.TXN_DATE) = 1
              AND CUST_CC_NO IN (SELECT '4' || repeat('0', greatest(0, 15 - length(CAST(user_id AS VARCHAR)))) || CAST(user_id AS VARCHAR) FROM events)"""),
    "monthly_bill_bulk": (("card", "txn"), f"""
        SELECT {_CARD} FROM card
        WHERE (CUST_CC_NO, year(card.TXN_DATE), month(card.TXN_DATE)) IN
              (SELECT (CUST_CC_NO, year(t.TXN_DATE), month(t.TXN_DATE)) FROM txn t)"""),
    "monthly_bill_bulk_stored": (("card", "txn"), f"""
        SELECT {_STORED_CARD} FROM card
        WHERE (CUST_CC_NO, year(card.TXN_DATE), month(card.TXN_DATE)) IN
              (SELECT (CUST_CC_NO, year(t.TXN_DATE), month(t.TXN_DATE)) FROM txn t)"""),
    "customer_txn_between": (("card",), f"""
        SELECT {_CARD} FROM card
        WHERE CUST_SSN = 7 AND card.TXN_DATE BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"""),
    "txn_by_zip_month": (("card", "customer_v"), f"""
        SELECT {_CARD}, CUST_ZIP FROM card JOIN customer_v ON CUST_SSN = SSN
        WHERE CUST_ZIP = 1007 AND year(card.TXN_DATE) = 1998 AND month(card.TXN_DATE) = 1"""),
    "type_totals": (("txn",), f"SELECT TRANSACTION_TYPE, count(*) AS TXN_COUNT, {_SUM} FROM txn GROUP BY 1"),
    "type_total_given": (("txn",), f"SELECT count(*) AS TXN_COUNT, {_SUM} FROM txn WHERE TRANSACTION_TYPE = 'ECONOMY'"),
    "type_total_any_case": (
        ("txn",),
        f"SELECT count(*) AS TXN_COUNT, {_SUM} FROM txn WHERE lower(TRANSACTION_TYPE) = lower('Economy')",
    ),
    "branch_state_totals": (
        ("txn", "branch_v"),
        f"SELECT BRANCH_STATE, count(*) AS TXN_COUNT, {_SUM} FROM txn JOIN branch_v USING (BRANCH_CODE) GROUP BY 1",
    ),
    "branch_state_total_given": (("txn", "branch_v"), f"""
        SELECT BRANCH_STATE, count(*) AS TXN_COUNT, {_SUM} FROM txn JOIN branch_v USING (BRANCH_CODE)
        WHERE BRANCH_STATE = 'NATION_3' GROUP BY 1"""),
    "txn_count_by_type": (("txn",), "SELECT TRANSACTION_TYPE, count(*) AS TXN_COUNT FROM txn GROUP BY 1"),
    "txn_count_by_type_share": (("txn",), """
        WITH g AS (SELECT TRANSACTION_TYPE, count(*) AS TXN_COUNT, CAST(sum(count(*)) OVER () AS BIGINT) AS TOTAL
                   FROM txn GROUP BY 1)
        SELECT *, {pct} AS PCT, {label} || ' (' || CAST(TXN_COUNT AS VARCHAR) || ')' AS PCT_LABEL FROM g""".format(
        pct=_pct("TXN_COUNT", "TOTAL"), label=_label("TXN_COUNT", "TOTAL")
    )),
    "customers_by_state": (("raw_customer",), "SELECT CUST_STATE, count(*) AS CUSTOMER_COUNT FROM raw_customer GROUP BY 1"),
    "top_customers": (("txn",), f"SELECT {_TOP_CUSTOMER_COLUMNS} FROM ({_TOP_CUSTOMERS})"),
    "top_customers_share": (("txn",), f"""
        WITH t AS ({_TOP_CUSTOMERS}), s AS (SELECT *, sum(v) OVER () AS total FROM t)
        SELECT {_TOP_CUSTOMER_COLUMNS}, CAST(total AS DOUBLE) AS TOTAL, {_pct('v', 'total')} AS PCT,
               {_label('v', 'total')} AS PCT_LABEL FROM s"""),
    "top_months": (("txn",), f"SELECT {_MONTH_COLUMNS} FROM ({_TOP_MONTHS})"),
    "top_months_share": (("txn",), f"""
        WITH t AS ({_TOP_MONTHS}), s AS (SELECT *, CAST(sum(TXN_COUNT) OVER () AS BIGINT) AS TOTAL FROM t)
        SELECT {_MONTH_COLUMNS}, TOTAL, {_pct('TXN_COUNT', 'TOTAL')} AS PCT,
               {_label('TXN_COUNT', 'TOTAL')} AS PCT_LABEL FROM s"""),
    "top_branches_for_type": (("txn",), """
        SELECT BRANCH_CODE, CAST(v AS DOUBLE) AS TOTAL_VALUE, CAST(trunc(v) AS BIGINT) AS WHOLE_VALUE
        FROM (SELECT BRANCH_CODE, sum(TRANSACTION_VALUE) AS v FROM txn WHERE TRANSACTION_TYPE = 'ECONOMY'
              GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)"""),
    "leader_type": (("txn",), "WITH g AS (SELECT TRANSACTION_TYPE, count(*) AS TXN_COUNT FROM txn GROUP BY 1) " + _LEADERS.format(m="TXN_COUNT")),
    "leader_state": (("raw_customer",), "WITH g AS (SELECT CUST_STATE, count(*) AS CUSTOMER_COUNT FROM raw_customer GROUP BY 1) " + _LEADERS.format(m="CUSTOMER_COUNT")),
    "leader_customer": (("txn",), f"WITH g AS (SELECT CUST_SSN, {_SUM} FROM txn GROUP BY 1) " + _LEADERS.format(m="TOTAL_VALUE")),
    "leader_branch": (("txn",), f"WITH g AS (SELECT BRANCH_CODE, {_SUM} FROM txn WHERE TRANSACTION_TYPE = 'ECONOMY' GROUP BY 1) " + _LEADERS.format(m="TOTAL_VALUE")),
    "loan_status_counts": (("loan",), """
        SELECT count(*) AS TOTAL, count(*) FILTER (WHERE Application_Status = 'Y') AS APPROVED,
               count(*) FILTER (WHERE Self_Employed = 'Yes') AS SELF_EMPLOYED,
               count(*) FILTER (WHERE Gender = 'Male' AND Married = 'Yes') AS MARRIED_MALE,
               count(*) FILTER (WHERE Gender = 'Male' AND Married = 'Yes' AND Application_Status = 'N') AS MARRIED_MALE_REJECTED
        FROM loan"""),
    "approval_rate_self_employed": (("loan",), _approval_rate("Application_Status = 'Y' AND Self_Employed = 'Yes'")),
    "approval_rate_as_written": (("loan",), _approval_rate("Application_Status = 'Y'")),
    "rejection_rate_married_male": (("loan",), f"""
        SELECT t AS TOTAL, n AS REJECTED, t - n AS APPROVED, {_pct('n', 't')} AS PCT
        FROM (SELECT count(*) AS t, count(*) FILTER (WHERE Application_Status = 'N') AS n
              FROM loan WHERE Gender = 'Male' AND Married = 'Yes')"""),
    "rejection_split_married_male": (("loan",), _SPLIT),
    "loan_segment_rates": (("loan",), _segment_rates(_SEGMENTS, "CUBE")),
    "loan_segment_rollup": (("loan",), _segment_rates("Property_Area, Education, Self_Employed", "ROLLUP")),
}

_FREQUENT = """
    SELECT concat_ws(', ', {names}) AS SEGMENT, CAST({used} AS INT) AS SEGMENTS, count(*) AS APPLICATIONS,
           count(*) FILTER (WHERE Application_Status = 'Y') AS APPROVED
    FROM loan GROUP BY CUBE ({all}) HAVING count(*) >= 100 AND {used} > 0""".format(
    names=", ".join(f"CASE WHEN grouping({c}) = 0 THEN '{c}=' || coalesce({c}, '?') END" for c in _SEGMENTS.split(", ")),
    used=" + ".join(f"(1 - grouping({c}))" for c in _SEGMENTS.split(", ")), all=_SEGMENTS,
)
_QUERIES["loan_frequent_segments"] = (("loan",), _FREQUENT)
_QUERIES["loan_target_segments"] = (("loan",), f"""
    WITH g AS ({_FREQUENT}), r AS (SELECT *, CAST(APPLICATIONS AS DOUBLE) AS n, CAST(APPROVED AS DOUBLE) / APPLICATIONS AS p FROM g)
    SELECT SEGMENT, SEGMENTS, APPLICATIONS, APPROVED, {_pct('APPROVED', 'APPLICATIONS')} AS PCT,
           round(100 * (p + 1.96::DOUBLE * 1.96::DOUBLE / (2 * n) - 1.96::DOUBLE * sqrt(p * (1 - p) / n + 1.96::DOUBLE * 1.96::DOUBLE / (4 * n * n)))
                 / (1 + 1.96::DOUBLE * 1.96::DOUBLE / n), 6) AS LOWER_PCT
    FROM r ORDER BY LOWER_PCT DESC, APPLICATIONS DESC, SEGMENT LIMIT 20""")

_QUERIES["schema_drift_report"] = (("raw_card",), """
    WITH t AS (
        SELECT unnest(['CREDIT_CARD_NO', 'TRANSACTION_TYPE']) AS FIELD, 'string' AS FOUND, 'string' AS DECLARED, 'none' AS DRIFT FROM raw_card
        UNION ALL SELECT unnest(['YEAR', 'MONTH', 'DAY', 'CUST_SSN', 'TRANSACTION_ID']), 'number', 'number', 'none' FROM raw_card
        UNION ALL SELECT 'TRANSACTION_VALUE', CASE WHEN TRANSACTION_TYPE = '5-LOW' THEN 'string' ELSE 'number' END, 'number',
                         CASE WHEN TRANSACTION_TYPE = '5-LOW' THEN 'other_type' ELSE 'none' END FROM raw_card
        UNION ALL SELECT 'CHANNEL', 'string', NULL, 'unknown_field' FROM raw_card WHERE TRANSACTION_TYPE = '1-URGENT'
        UNION ALL SELECT 'DEVICE', 'object', NULL, 'unknown_field' FROM raw_card WHERE TRANSACTION_VALUE >= 200000)
    SELECT FIELD, FOUND, DECLARED, count(*) AS "ROWS", DRIFT FROM t GROUP BY ALL
    UNION ALL SELECT 'BRANCH_CODE', NULL, 'number', 0, 'missing_field'""")

# Tables that grow give what one load of everything gives.
_SAME = {
    "top_customers_summed": "top_customers", "top_months_summed": "top_months", "type_totals_summed": "type_totals",
    "txn_count_by_type_summed": "txn_count_by_type", "top_branches_for_type_summed": "top_branches_for_type",
    "branch_state_totals_summed": "branch_state_totals", "type_totals_grown": "type_totals",
    "customer_email_stored": "customer_email_upsert",
}
_QUERIES.update({name: _QUERIES[other] for name, other in _SAME.items()})


def _needed(names: tuple[str, ...], found: list[str]) -> list[str]:
    for name in names:
        _needed(_VIEWS[name][0], found)
        if name not in found:
            found.append(name)
    return found


def _sql(views: tuple[str, ...], text: str) -> str:
    """The query with the views it reads in front; its own WITH goes behind them."""
    clauses = [f"{name} AS ({_VIEWS[name][1]})" for name in _needed(views, [])]
    if not clauses:
        return text
    body = text.strip()
    if body.startswith("WITH "):
        return "WITH " + ",\n".join(clauses) + ",\n" + body[len("WITH "):]
    return "WITH " + ",\n".join(clauses) + "\n" + body


ORACLES: dict[str, str] = {name: _sql(views, text) for name, (views, text) in _QUERIES.items()}
