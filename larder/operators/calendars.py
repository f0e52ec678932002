"""Generated dimensions and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions.dates import date_key, financial_date, iso_year, monday_of


def dim_time(spark: SparkSession) -> DataFrame:
    """Minutes of a day."""
    minute = spark.range(24 * 60)
    return minute.select(
        F.format_string("%02d%02d", F.floor(F.col("id") / 60), F.col("id") % 60).alias("pk_time"),
        F.floor(F.col("id") / 60).cast("int").alias("hour"),
        (F.col("id") % 60).cast("int").alias("minute"),
    )


def dim_periods(spark: SparkSession, days: int = 50_000) -> DataFrame:
    """Days since, with the same distance in longer periods."""
    d = F.col("id")
    return spark.range(days + 1).select(
        d.cast("int").alias("days_since"),
        F.floor(d / 7).cast("int").alias("weeks_since"),
        F.floor(d / 30).cast("int").alias("months_since"),
        F.floor(d / 365 * 4).cast("int").alias("quarters_since"),
        F.floor(d / 365).cast("int").alias("years_since"),
    )


def days_from(first: DataFrame, days: int) -> DataFrame:
    """``days`` consecutive dates from the ``day`` of a one-row frame."""
    return first.select(F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("day"))


def date_grid(spark: SparkSession, start: Column | str, end: Column | str, step: str = "1 day") -> DataFrame:
    """Dates from start to end inclusive."""
    lo = F.lit(start).cast("date") if isinstance(start, str) else start
    hi = F.lit(end).cast("date") if isinstance(end, str) else end
    return spark.range(1).select(F.explode(F.sequence(lo, hi, F.expr(f"interval {step}"))).alias("day"))


def financial_calendar(days: DataFrame) -> DataFrame:
    """Financial periods of dates.

    Periods follow the Monday of the week; the week of 2024-09-30 belongs to
    the next month and quarter, and week 1 starting in December is week 53.
    The day counters are windows over one quarter or month of dates.
    """
    monday = monday_of("day")
    week = F.weekofyear("day")
    moved = (F.year("monday_date") == 2024) & (F.col("calendar_week") == 40)
    out = days.select(
        "day",
        date_key("day").alias("pk_date"),
        iso_year("day").cast("int").alias("calendar_week_year"),
        week.alias("calendar_week"),
        monday.alias("monday_date"),
        financial_date(monday).alias("financial_date"),
        F.year(monday).alias("financial_year"),
    )
    out = out.withColumns(
        {
            "financial_week": F.when(
                (F.month("monday_date") == 12) & (F.col("calendar_week") == 1), 53
            ).otherwise(F.col("calendar_week")),
            "financial_quarter": F.when(moved, 4).otherwise(F.quarter("monday_date")),
            "financial_month": F.when(moved, 10).otherwise(F.month("monday_date")),
        }
    )
    q = Window.partitionBy("financial_year", "financial_quarter").orderBy("day")
    m = Window.partitionBy("financial_year", "financial_month").orderBy("day")
    return out.withColumns(
        {
            "day_of_financial_year": 7 * (F.col("financial_week") - 1) + F.weekday("day") + 1,
            "day_of_financial_quarter": F.row_number().over(q),
            "day_of_financial_month": F.row_number().over(m),
        }
    )
