"""Reports on loan applications. Each counts in a single pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions import columns as fn

SEGMENTS = ("Gender", "Married", "Education", "Self_Employed", "Property_Area")

# Fixed values of the loan data.
APPROVED, REJECTED = "Y", "N"


def _is(name: str, value: str) -> Column:
    return F.col(name) == value


def _approved() -> Column:
    return _is("Application_Status", APPROVED)


def _rejected() -> Column:
    return _is("Application_Status", REJECTED)


def _self_employed() -> Column:
    return _is("Self_Employed", "Yes")


def _married_man() -> Column:
    return _is("Gender", "Male") & _is("Married", "Yes")


def status_counts(loans: DataFrame) -> DataFrame:
    return loans.agg(
        F.count("*").alias("TOTAL"),
        F.count_if(_approved()).alias("APPROVED"),
        F.count_if(_self_employed()).alias("SELF_EMPLOYED"),
        F.count_if(_married_man()).alias("MARRIED_MALE"),
        F.count_if(_married_man() & _rejected()).alias("MARRIED_MALE_REJECTED"),
    )


def approval_rate_self_employed(loans: DataFrame, as_written: bool = False) -> DataFrame:
    """Percent approved among the self-employed.

    ``as_written`` divides all approved applications by the self-employed ones,
    a ratio that may pass 100.
    """
    counted = _approved() if as_written else _approved() & _self_employed()
    numbers = loans.agg(
        F.count("*").alias("TOTAL"),
        F.count_if(counted).alias("APPROVED"),
        F.count_if(_self_employed()).alias("SELF_EMPLOYED"),
    )
    return numbers.withColumn("PCT", fn.percent(F.col("APPROVED"), F.col("SELF_EMPLOYED")))


def rejection_rate_married_male(loans: DataFrame) -> DataFrame:
    """Percent rejected among married men, with both parts of the split."""
    numbers = loans.where(_married_man()).agg(
        F.count("*").alias("TOTAL"), F.count_if(_rejected()).alias("REJECTED")
    )
    return numbers.select(
        "TOTAL",
        "REJECTED",
        (F.col("TOTAL") - F.col("REJECTED")).alias("APPROVED"),
        fn.percent(F.col("REJECTED"), F.col("TOTAL")).alias("PCT"),
    )


def rejection_split_married_male(loans: DataFrame) -> DataFrame:
    """The same split as two labelled rows, ready for a chart."""
    rate = rejection_rate_married_male(loans)
    slices = rate.select(
        F.stack(
            F.lit(2),
            F.lit("Approved"), F.col("APPROVED"), F.col("TOTAL"),
            F.lit("Rejected"), F.col("REJECTED"), F.col("TOTAL"),
        ).alias("STATUS", "APPLICATIONS", "TOTAL")
    )
    part, of = F.col("APPLICATIONS"), F.col("TOTAL")
    return slices.select(
        "STATUS", "APPLICATIONS", fn.percent(part, of).alias("PCT"), fn.percent_label(part, of).alias("PCT_LABEL")
    )


def segment_rates(loans: DataFrame, segments: tuple[str, ...] = SEGMENTS, how: str = "cube") -> DataFrame:
    """Applications, approvals and approval rate for every combination of segments.

    ``IN_<column>`` is 1 when a row is broken down by that column and 0 when it
    sums over it. A cube copies its input once per combination, so the loans are
    first counted per full combination and only those few rows are copied.
    """
    base = loans.groupBy(*segments).agg(
        F.count("*").alias("n"), F.count_if(_approved()).alias("a")
    )
    grouped = base.cube(*segments) if how == "cube" else base.rollup(*segments)
    rates = grouped.agg(
        *[(1 - F.grouping(s)).cast("int").alias(f"IN_{s}") for s in segments],
        F.sum("n").alias("APPLICATIONS"),
        F.sum("a").alias("APPROVED"),
    )
    return rates.withColumn("PCT", fn.percent(F.col("APPROVED"), F.col("APPLICATIONS")))


# Deviates of the normal distribution below which 97.5 % lie: the rate lies above its bound that surely.
SURE = 1.96
LEAST_SUPPORT = 100


def lower_bound(part: Column, of: Column, deviates: float = SURE) -> Column:
    """The lower confidence bound (Wilson) of a rate, in percent; low for few observations."""
    n, p, z = of.cast("double"), part.cast("double") / of.cast("double"), F.lit(deviates)
    spread = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.round(100 * (p + z * z / (2 * n) - spread) / (1 + z * z / n), 6)


def frequent_segments(loans: DataFrame, segments: tuple[str, ...] = SEGMENTS, least: int = LEAST_SUPPORT) -> DataFrame:
    """The breakdowns of ``segment_rates`` that hold ``least`` applications at least, without the total.

    An iceberg cube: no group is larger than one that it is a part of, so values of a
    segment that do not hold enough by themselves are cut before they are combined
    with others, and what is left is counted per full combination once. A missing
    value is a segment of its own. ``SEGMENT`` names the group.
    """
    base = loans.groupBy(*segments).agg(F.count("*").alias("n"), F.count_if(_approved()).alias("a"))
    for s in segments:
        enough = base.groupBy(s).agg(F.sum("n").alias("_n")).where(F.col("_n") >= least).select(F.col(s).alias("_value"), F.lit(True).alias("_enough"))
        value = F.when(F.col("_enough"), F.concat(F.lit(f"{s}="), F.coalesce(F.col(s).cast("string"), F.lit("?"))))
        base = base.join(enough, F.col(s).eqNullSafe(F.col("_value")), "left").withColumn(f"_{s}", value).drop("_value", "_enough")
    names = [f"_{s}" for s in segments]
    base = base.groupBy(*names).agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
    groups = base.cube(*names).agg(
        sum((1 - F.grouping(c) for c in names), F.lit(0)).cast("int").alias("SEGMENTS"),
        sum(((F.grouping(c) == 0) & F.col(c).isNull()).cast("int") for c in names).alias("cut"),
        F.sum("n").alias("APPLICATIONS"), F.sum("a").alias("APPROVED"),
    )
    groups = groups.where((F.col("cut") == 0) & (F.col("SEGMENTS") > 0) & (F.col("APPLICATIONS") >= least))
    return groups.select(F.concat_ws(", ", *names).alias("SEGMENT"), "SEGMENTS", "APPLICATIONS", "APPROVED")


def target_segments(loans: DataFrame, segments: tuple[str, ...] = SEGMENTS, least: int = LEAST_SUPPORT, k: int = 20) -> DataFrame:
    """The ``k`` groups worth targeting: of those large enough, the ones whose approval rate is surely highest."""
    groups = frequent_segments(loans, segments, least)
    rates = groups.withColumns(
        {"PCT": fn.percent(F.col("APPROVED"), F.col("APPLICATIONS")), "LOWER_PCT": lower_bound(F.col("APPROVED"), F.col("APPLICATIONS"))}
    )
    return rates.orderBy(F.col("LOWER_PCT").desc(), F.col("APPLICATIONS").desc(), "SEGMENT").limit(k)
