"""Date spine and calendar attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedforge.functions.columns import date_key, day_of_week, is_weekend, month_key

# Span of the calendar; the end is exclusive.
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)


def date_spine(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END,
               inclusive: bool = False) -> DataFrame:
    """One row per day, column ``full_date``."""
    last = F.lit(end) if inclusive else F.date_sub(F.lit(end), 1)
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), last)).alias("full_date"))


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END,
             inclusive: bool = False) -> DataFrame:
    """Calendar dimension: keys, names and flags of every day."""
    day = F.col("full_date")
    return date_spine(spark, start, end, inclusive).select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_name_short"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_name_short"),
        is_weekend(day).alias("is_weekend"),
        month_key(day).alias("year_month_key"),
    )


def relative_flags(calendar: DataFrame, as_of: Column | date | None = None) -> DataFrame:
    """Flags relative to a day (today by default).

    The week flag compares calendar year and ISO week, so it is off in the days
    around New Year; existing tables do the same.
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    same_year = F.col("year") == F.year(today)
    return calendar.withColumns({
        "is_today": F.col("full_date") == today,
        "is_current_week": same_year & (F.col("week_of_year") == F.weekofyear(today)),
        "is_current_month": same_year & (F.col("month") == F.month(today)),
        "is_current_year": same_year,
        "days_from_today": F.datediff("full_date", today),
    })


def with_holidays(calendar: DataFrame, holidays: DataFrame) -> DataFrame:
    """``is_holiday`` from a table with a ``holiday_date`` column.

    Repeated dates are collapsed first, so there is at most one match per day.
    """
    marked = holidays.select(F.col("holiday_date").alias("full_date")).distinct() \
        .withColumn("is_holiday", F.lit(True))
    return calendar.join(marked, "full_date", "left").withColumn(
        "is_holiday", F.coalesce("is_holiday", F.lit(False)))
