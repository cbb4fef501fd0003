"""Calendar expressions: months, fiscal periods and the period spellings of landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def as_date(value: Column) -> Column:
    """DATE from a date, timestamp or text; text that is no date gives NULL."""
    return value.try_cast("date")


def month_of(value: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(as_date(value), "month")


def days_in_month(month: Column) -> Column:
    return F.dayofmonth(F.last_day(month))


def fiscal_year(value: Column) -> Column:
    """The fiscal year starts in October and carries the next year's number."""
    day = as_date(value)
    return F.year(day) + F.when(F.month(day) >= 10, 1).otherwise(0)


def fiscal_quarter(value: Column) -> Column:
    """Q1 is October to December."""
    quarter = F.pmod(F.quarter(as_date(value)), F.lit(4)) + 1
    return F.concat(F.lit("Q"), quarter.cast("string"))


def parse_quarter_period(period: Column) -> Column:
    """``2024Q3`` -> 2024-07-01; an unknown quarter counts as the first; without a
    ``Q`` the text is a date or a bare year."""
    text = F.upper(period.cast("string"))
    parts = F.split(text, "Q")
    month = F.coalesce(
        F.when(parts[1].startswith("2"), "04").when(parts[1].startswith("3"), "07").when(parts[1].startswith("4"), "10"),
        F.lit("01"),
    )
    quarterly = F.concat_ws("-", F.substring(parts[0], 1, 4), month, F.lit("01"))
    return F.when(text.contains("Q"), quarterly).otherwise(_date_or_year(period)).transform(_strict_date)


def parse_compact_period(period: Column) -> Column:
    """``YYYYMM`` -> first of that month; shorter text is a bare year."""
    text = period.cast("string")
    monthly = F.concat_ws("-", F.substring(text, 1, 4), F.lpad(F.substring(text, 5, 2), 2, "0"), F.lit("01"))
    return F.when(F.length(text) >= 6, monthly).otherwise(F.concat(text, F.lit("-01-01"))).transform(_strict_date)


def parse_index_date(period: Column) -> Column:
    """``YYYY[-/]M`` at the start of the text -> first of that month; a missing
    month counts as January."""
    text = period.cast("string")
    pattern = r"^(\d{4})[-/]?(\d{1,2})?"
    month = F.lpad(F.coalesce(F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")), F.lit("1")), 2, "0")
    monthly = F.concat_ws("-", F.regexp_extract(text, pattern, 1), month, F.lit("01"))
    return F.when(text.rlike(pattern), monthly).otherwise(_date_or_year(period)).transform(_strict_date)


def parse_plain_period(period: Column) -> Column:
    """A date (its first ten characters) or a bare year, as JSON index files carry."""
    return _date_or_year(period).transform(_strict_date)


def _strict_date(text: Column) -> Column:
    """DATE from ``YYYY-MM-DD``; a year of five digits is an error in the file, not a date."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).try_cast("date")


def _date_or_year(period: Column) -> Column:
    text = period.cast("string")
    return F.when(F.length(text) >= 10, F.substring(text, 1, 10)).otherwise(F.concat(text, F.lit("-01-01")))


def _months_between(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 month")))


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per month from ``start`` to ``end`` (both included)."""
    first, last = month_of(F.lit(start)), month_of(F.lit(end))
    return spark.range(1, numPartitions=1).select(_months_between(first, last).alias("month"))


def month_spine_of(df: DataFrame, date_col: str) -> DataFrame:
    """One row per month over the range of ``date_col``: no gaps, whatever the data holds."""
    day = as_date(F.col(date_col))
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).where(F.col("first").isNotNull())
    return span.select(_months_between(F.trunc("first", "month"), F.trunc("last", "month")).alias("month"))
