"""Customers eligible for the repeat-purchase campaign."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.functions.numbers import safe_ratio

OPEN_STATUSES = ("Processing", "Shipped")
MIN_DAYS, MAX_DAYS = 30, 90
MAX_RETURN_SHARE = 0.5


def customer_rollup(orders: DataFrame) -> DataFrame:
    """Per customer: order counts and the newest order.

    The newest order comes out of the same grouping as a ``max`` over a struct
    that starts with the sort keys. There is one shuffle, and it moves partial
    results, so a customer with very many orders is no hot spot.
    """
    newest = F.max(F.struct("created_at", "order_id", "status", "delivered_at"))
    return (orders.groupBy("user_id")
            .agg(F.count("*").alias("lifetime_orders"),
                 F.count_if(F.col("status") == "Returned").alias("lifetime_returns"),
                 F.count_if(F.col("status").isin(*OPEN_STATUSES)).alias("open_orders"),
                 newest.alias("last")))


def last_orders(orders: DataFrame) -> DataFrame:
    return customer_rollup(orders).select("user_id", "last.*")


def order_values(items: DataFrame) -> DataFrame:
    """Value of each order.

    Lines are summed per order before any join: what moves is one partial sum
    per order and task, however many lines an order has.
    """
    return items.groupBy("order_id").agg(F.sum("sale_price").alias("order_value"))


def last_order_values(items: DataFrame, last: DataFrame) -> DataFrame:
    """Value of each customer's last order."""
    return order_values(items).join(last.select("order_id"), "order_id", "left_semi")


def repeat_campaign(orders: DataFrame, items: DataFrame, as_of: dt.date) -> DataFrame:
    """Last order complete and delivered 30 to 90 days ago, nothing open, few returns."""
    delivered = F.to_date("last.delivered_at")
    eligible = (customer_rollup(orders)
                .filter((F.col("last.status") == "Complete")
                        & delivered.between(F.lit(as_of - dt.timedelta(days=MAX_DAYS)),
                                            F.lit(as_of - dt.timedelta(days=MIN_DAYS)))
                        & (F.col("open_orders") == 0)
                        & (safe_ratio(F.col("lifetime_returns"), F.col("lifetime_orders")) <= MAX_RETURN_SHARE))
                .select("user_id", F.col("last.order_id").alias("order_id"),
                        F.col("last.created_at").alias("last_ordered_at"),
                        F.col("last.delivered_at").alias("last_delivered_at"),
                        F.datediff(F.lit(as_of), delivered).alias("days_since_delivery"),
                        "lifetime_orders", "lifetime_returns"))
    return eligible.join(order_values(items), "order_id", "left").select(
        "user_id", F.col("order_id").alias("last_order_id"), "last_ordered_at", "last_delivered_at",
        "days_since_delivery", F.col("order_value").cast("decimal(18,2)").alias("last_order_value"),
        "lifetime_orders", "lifetime_returns")
