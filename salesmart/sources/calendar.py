"""Generated calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.unions import union_by_name


def calendar(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included; no rows if the end lies before the start."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return _days(spark.range(1).select(first.alias("first_day"), last.alias("last_day")))


def _days(span: DataFrame) -> DataFrame:
    days = F.sequence("first_day", F.greatest("first_day", "last_day"), F.expr("interval 1 day"))
    return span.select(F.explode(days).alias("full_date"), "last_day").where("full_date <= last_day").select("full_date")


def calendar_years(df: DataFrame, dates: Column | str, *more: tuple[DataFrame, Column | str]) -> DataFrame:
    """One row per day over every calendar year touched by ``dates`` of ``df`` or those of ``more`` sources, and the years between them.

    Each source gives its least and greatest date, one row each, so the calendar follows the data instead of a constant.
    Sources without any date give no rows.
    """
    spans = []
    for source, column in ((df, dates), *more):
        day = (F.col(column) if isinstance(column, str) else column).cast("date")
        spans.append(source.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")))
    whole = union_by_name(spans).agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    return _days(whole.where(F.col("first_day").isNotNull()).select(
        F.trunc("first_day", "year").alias("first_day"), F.date_sub(F.add_months(F.trunc("last_day", "year"), 12), 1).alias("last_day")))


def calendar_attributes(days: DataFrame, day: str = "full_date") -> DataFrame:
    """Calendar columns; weeks are ISO weeks, weekdays count from Sunday = 1."""
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofyear(day).alias("day_of_year"),
    )
