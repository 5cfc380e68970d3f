"""End-of-day status of every order, rebuilt from its milestone timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.operators.calendar import days_between

HISTORY_DAYS = 365
DAYS_AFTER_FINAL = 30


def order_status_snapshot(orders: DataFrame, as_of: dt.date, first_day: dt.date | None = None,
                          last_day: dt.date | None = None) -> DataFrame:
    """One row per order and day, for the year that ends the day before ``as_of``.

    Each order expands over its own span of days, which is what joining it to
    the calendar would keep. There is no join and no shuffle, and an order
    never gives more than a year of rows.
    """
    first_day = max(first_day or dt.date.min, as_of - dt.timedelta(days=HISTORY_DAYS))
    last_day = min(last_day or dt.date.max, as_of - dt.timedelta(days=1))
    created = F.to_date("created_at")
    final = F.coalesce(F.to_date("returned_at"), F.to_date("delivered_at"),
                       F.when(F.col("status") == "Cancelled", created))
    spans = orders.select(
        "order_id", "user_id", F.col("status").alias("current_status"),
        created.alias("created_date"), F.to_date("shipped_at").alias("shipped_date"),
        F.to_date("delivered_at").alias("delivered_date"), F.to_date("returned_at").alias("returned_date"),
        F.greatest(created, F.lit(first_day)).alias("first_day"),
        F.least(F.lit(last_day), F.date_add(final, DAYS_AFTER_FINAL)).alias("last_day"))
    # A sequence runs backwards when its ends are swapped, hence the filter.
    days = (spans.filter(F.col("created_date").isNotNull() & (F.col("first_day") <= F.col("last_day")))
            .withColumn("snapshot_date", F.explode(days_between(F.col("first_day"), F.col("last_day")))))
    day = F.col("snapshot_date")
    status = (F.when(F.col("returned_date") <= day, "Returned")
              .when(F.col("delivered_date") <= day, "Complete")
              .when(F.col("current_status") == "Cancelled", "Cancelled")
              .when(F.col("shipped_date") <= day, "Shipped")
              .otherwise("Processing"))
    return days.select("snapshot_date", "order_id", "user_id", status.alias("status_on_date"),
                       F.datediff(day, F.col("created_date")).alias("order_age_days"))


def snapshot_of_day(orders: DataFrame, day: dt.date) -> DataFrame:
    """The snapshot rows of one day, to append to a frozen history."""
    return order_status_snapshot(orders, day + dt.timedelta(days=1), first_day=day, last_day=day)
