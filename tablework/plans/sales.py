"""Daily sales by local date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.clock import local_date, local_day_start

NOT_REVENUE = ("Cancelled", "Returned")


def daily_sales(items: DataFrame, tz: str) -> DataFrame:
    """Distinct orders and net revenue per local date."""
    revenue = F.when(~F.col("status").isin(*NOT_REVENUE), F.col("sale_price")).otherwise(0)
    return (items.groupBy(local_date(F.col("created_at"), tz).alias("sales_date"))
            .agg(F.count_distinct("order_id").alias("orders"),
                 F.sum(revenue).cast("decimal(18,2)").alias("net_revenue")))


def on_local_day(created_at: str, day: dt.date, tz: str):
    """Predicate for one local day, which is 23, 24 or 25 hours long.

    Both edges fold to literals, so the predicate can reach the scan.
    """
    start = local_day_start(day, tz)
    end = local_day_start(day + dt.timedelta(days=1), tz)
    return (F.col(created_at) >= start) & (F.col(created_at) < end)


def daily_sales_of(items: DataFrame, day: dt.date, tz: str) -> DataFrame:
    return daily_sales(items.filter(on_local_day("created_at", day, tz)), tz)
