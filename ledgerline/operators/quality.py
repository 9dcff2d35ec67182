"""Validation of deliveries: accepted rows, rejected rows with a reason, a report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions import columns as fn
from ledgerline.operators.keyed import distinct_keys, one_per_key, surplus
from ledgerline.schemas import LOAN_COLUMNS, LOAN_LENGTHS

REASON = "reject_reason"
DUPLICATE = "duplicate_key"
STORED = "already_stored"
CORRUPT = "_corrupt_record"
LOST = "lost_in_corrupt"


@dataclass(frozen=True)
class Rule:
    """A named defect; ``broken`` is true for rows that have it.

    ``given`` are the values that ``broken`` reads by name. ``flag`` computes each
    once a row, however often conditions name it.
    """

    reason: str
    broken: Column
    given: dict[str, Column] = field(default_factory=dict)


def required(name: str) -> Rule:
    return Rule(f"missing:{name}", F.col(name).isNull())


def longest(name: str, limit: int) -> Rule:
    return Rule(f"too_long:{name}", F.char_length(F.col(name)) > limit)


def _number(name: str) -> tuple[Column, dict[str, Column]]:
    """The column as a whole number, by the name that the rules share, and what is given under it."""
    own = f"_whole_{name}"
    return F.col(own), {own: fn.whole_number(F.col(name))}


def whole(name: str) -> Rule:
    """A text that is there must spell a whole number, also as ``1.0``."""
    number, given = _number(name)
    return Rule(f"not_whole:{name}", F.col(name).isNotNull() & number.isNull(), given)


def zip_code(name: str) -> list[Rule]:
    """Five digits at most; a longer code is not cut."""
    digits, given = _number(name)
    return [whole(name), Rule(f"too_long:{name}", (digits < 0) | (digits > 99_999), given)]


def money(name: str) -> Rule:
    return Rule(f"not_money:{name}", F.col(name).isNotNull() & fn.amount(F.col(name)).isNull())


def real_date(*parts: str) -> Rule:
    """Year, month and day are there and name a day that exists."""
    given = {f"_int_{part}": fn.whole_number(F.col(part)).try_cast("int") for part in parts}
    return Rule("no_date:" + "-".join(parts), fn.calendar_date(*map(F.col, given)).isNull(), given)


def not_corrupt() -> Rule:
    return Rule("corrupt_record", F.col(CORRUPT).isNotNull())


def loan_rules() -> list[Rule]:
    """Key present, texts within their column's length, whole-number history."""
    history, given = _number("Credit_History")
    return [
        required("Application_ID"),
        *[longest(name, limit) for name, limit in LOAN_LENGTHS.items()],
        whole("Credit_History"),
        Rule("too_large:Credit_History", F.abs(history) > 2_147_483_647, given),
    ]


def branch_rules() -> list[Rule]:
    return [required("BRANCH_CODE"), whole("BRANCH_CODE"), *zip_code("BRANCH_ZIP")]


def customer_rules() -> list[Rule]:
    return [required("SSN"), whole("SSN"), *zip_code("CUST_ZIP")]


def transaction_rules() -> list[Rule]:
    """Nothing that bills, ranges and totals need may be missing or misspelt."""
    return [
        *[required(name) for name in ("TRANSACTION_ID", "CREDIT_CARD_NO", "CUST_SSN", "TRANSACTION_VALUE")],
        *[whole(name) for name in ("TRANSACTION_ID", "CUST_SSN", "BRANCH_CODE")],
        money("TRANSACTION_VALUE"),
        real_date("YEAR", "MONTH", "DAY"),
    ]


def flag(batch: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds the first broken rule's name, NULL for sound rows. No shuffle."""
    if CORRUPT in batch.columns:
        rules = [not_corrupt(), *rules]
    first, *rest = rules
    reason = F.when(first.broken, F.lit(first.reason))
    for rule in rest:
        reason = reason.when(rule.broken, F.lit(rule.reason))
    given = {name: value for rule in rules for name, value in rule.given.items()}
    return batch.withColumns(given).withColumn(REASON, reason).drop(*given) if given else batch.withColumn(REASON, reason)


def _sound(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(REASON).isNull()).drop(REASON, CORRUPT)


def accepted(flagged: DataFrame, key: str | None = None, newest: Column | None = None) -> DataFrame:
    """Sound rows; with a key, each key once.

    Of several rows with one key the one with the greatest ``newest`` stays, NULL
    being the least; without that, and among equals, the smallest by column order.
    """
    sound = _sound(flagged)
    if key is None:
        return sound
    order = [] if newest is None else [newest.desc_nulls_last()]
    return one_per_key(sound, [key], order + [F.col(name).asc() for name in sound.columns if name != key])


def rejected(
    flagged: DataFrame, key: str | None = None, newest: Column | None = None, kept: DataFrame | None = None
) -> DataFrame:
    """Every row that ``accepted`` leaves out, with reason and number of equal rows.

    ``kept`` is what ``accepted`` gave, where it is written already and need not be
    made again.
    """
    broken = flagged.where(F.col(REASON).isNotNull())
    broken = broken.groupBy(*broken.columns).agg(F.count("*").alias("copies"))
    if key is None:
        return broken
    sound = _sound(flagged)
    kept = accepted(flagged, key, newest) if kept is None else kept
    repeats = surplus(sound, kept).withColumn(REASON, F.lit(DUPLICATE))
    return broken.unionByName(repeats, allowMissingColumns=True)


def duplicate_keys(batch: DataFrame, key: str) -> DataFrame:
    counts = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies"))
    return counts.where(F.col("copies") > 1)


# Fixed value: a list of so many keys is some 4 MB. Spark takes a list's size from the
# files it is read from, which hold keys packed to a tenth or less, and would send
# longer lists through the driver.
MOST_NAMED = 100_000


def _dealt(keys: DataFrame, named: int | None) -> DataFrame:
    """Keys that a join shuffles if they are known to be many, and else broadcasts as Spark decides."""
    return keys if named is None or named <= MOST_NAMED else keys.hint("merge")


def held_keys(wanted: DataFrame, stored: DataFrame, key: str, named: int | None = None) -> DataFrame:
    """The stored keys that ``wanted`` names: a short list.

    A stored table is large and a batch often small. The batch's keys are the
    right side, so Spark broadcasts them when they are few and the stored keys
    are not shuffled. ``named`` is the number of ``wanted`` rows, where it is known.
    """
    return stored.select(key).join(_dealt(distinct_keys(wanted, key), named), key, "left_semi")


def new_only(batch: DataFrame, stored: DataFrame, key: str, named: int | None = None) -> DataFrame:
    """Rows whose key the stored table does not hold yet."""
    return batch.join(_dealt(held_keys(batch, stored, key, named), named), key, "left_anti")


def already_stored(batch: DataFrame, stored: DataFrame, key: str, named: int | None = None) -> DataFrame:
    """Rows whose key the stored table already holds."""
    return batch.join(_dealt(held_keys(batch, stored, key, named), named), key, "left_semi")


def check_lines(flagged: DataFrame) -> None:
    """Raises when the damaged records are lines of documents that span lines."""
    if CORRUPT in flagged.columns and not flagged.where(F.trim(CORRUPT).isin("[", "{", "[{")).isEmpty():
        raise ValueError("the documents span lines: read them with multi_line=True")


def load_report(flagged: DataFrame, key: str | None = None) -> DataFrame:
    """Rows per outcome: ``read``, ``accepted``, and one line per reject reason.

    ``read`` and ``accepted`` are there also when nothing was delivered. A damaged
    array document is one damaged row; the records it names are its loss and
    count as read: ``lost_in_corrupt``. Rows are counted per (reason, key) first,
    inside the map tasks, so neither a hot key nor a frequent reason weighs on
    one task. Broken rows need no key.
    """
    lost = _lost_records(flagged)
    sound = F.col(REASON).isNull()
    if key is None:
        counted = flagged.groupBy(REASON).agg(F.count("*").alias("n")).withColumn("keys", F.col("n"))
    else:
        per_key = flagged.groupBy(F.col(REASON), F.when(sound, F.col(key)).alias("_key")).agg(
            F.count("*").alias("n")
        )
        counted = per_key.groupBy(REASON).agg(F.sum("n").alias("n"), F.count("*").alias("keys"))
    outcomes = counted.select(
        F.stack(
            F.lit(3),
            F.lit("read"), F.col("n"),
            F.coalesce(F.col(REASON), F.lit("accepted")), F.when(sound, F.col("keys")).otherwise(F.col("n")),
            F.lit(DUPLICATE), F.when(sound, F.col("n") - F.col("keys")).otherwise(F.lit(0).cast("bigint")),
        ).alias("outcome", "rows")
    )
    always = flagged.sparkSession.createDataFrame([("read", 0), ("accepted", 0)], "outcome string, rows bigint")
    found = outcomes.unionByName(always).unionByName(lost).groupBy("outcome").agg(F.sum("rows").alias("rows"))
    return found.where("rows > 0 or outcome in ('read', 'accepted')")


# The keys by which records are told in a damaged document.
_KEYS = ("Application_ID", "TRANSACTION_ID", "SSN", "BRANCH_CODE")


def _lost_records(flagged: DataFrame) -> DataFrame:
    """Records that damaged documents name beyond the one row that each is counted as."""
    if CORRUPT not in flagged.columns:
        return flagged.sparkSession.createDataFrame([], "outcome string, rows bigint")
    named = F.greatest(*(F.regexp_count(CORRUPT, F.lit(f'"{key}"\\s*:')) for key in _KEYS)) - 1
    n = F.coalesce(F.sum(F.when(named > 0, named)), F.lit(0)).cast("bigint")
    lost = flagged.where(F.col(CORRUPT).isNotNull()).agg(n.alias("n"))
    return lost.select(F.stack(F.lit(2), F.lit("read"), F.col("n"), F.lit(LOST), F.col("n")).alias("outcome", "rows"))


def check_reject_rate(report: DataFrame, most: float) -> None:
    """Raises when nothing was accepted, or a larger share than ``most`` of the rows read rejected.

    Repeated rows are no defect of the delivery and count as accepted. Brings
    three counts to the driver.
    """
    named = {"read": "read", "kept": "accepted", "again": DUPLICATE}
    counts = [
        F.coalesce(F.sum(F.when(F.col("outcome") == outcome, F.col("rows"))), F.lit(0)).alias(name)
        for name, outcome in named.items()
    ]
    found = report.agg(*counts).first()
    bad = found.read - found.kept - found.again
    if not found.kept:
        raise ValueError(f"none of {found.read} rows accepted")
    if bad > most * found.read:
        raise ValueError(f"{bad} of {found.read} rows rejected, more than the allowed share {most}")


def as_stored_loan(rows: DataFrame) -> DataFrame:
    """The ten stored columns in stored types."""
    return rows.select(
        *[fn.whole_number(F.col(n)).cast("int").alias(n) if n == "Credit_History" else F.col(n) for n in LOAN_COLUMNS]
    )
