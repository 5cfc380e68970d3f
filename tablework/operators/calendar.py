"""Calendar relations and day-by-day expansion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ONE_DAY = "interval 1 day"


def days_between(first: Column, last: Column) -> Column:
    """Array of dates, both ends included."""
    return F.sequence(first, last, F.expr(ONE_DAY))


def date_spine(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per day from the first order date through ``as_of``."""
    first = orders.agg(F.to_date(F.min("created_at")).alias("first_day"))
    days = (first.filter(F.col("first_day") <= F.lit(as_of))
            .select(F.explode(days_between(F.col("first_day"), F.lit(as_of))).alias("calendar_date")))
    return days.select("calendar_date", *calendar_columns(F.col("calendar_date"), as_of))


def calendar_columns(day: Column, as_of: dt.date) -> list[Column]:
    return [
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).alias("day_of_week_index"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        (F.dayofmonth(day) <= F.dayofmonth(F.lit(as_of))).alias("is_month_to_date"),
        F.datediff(F.lit(as_of), day).alias("days_ago"),
    ]


def zero_filled_daily(spine: DataFrame, daily: DataFrame, counts: list[str]) -> DataFrame:
    """Every calendar day with its counts; a day without rows shows zero.

    ``daily`` is one row per ``calendar_date``, so both sides have at most one
    row per day.
    """
    joined = spine.select("calendar_date").join(daily, "calendar_date", "left")
    return joined.select("calendar_date", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
