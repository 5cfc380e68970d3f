"""Retail queries: local days, calendar, snapshot, campaign."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablework.catalog import shapes_sql as sql
from tablework.catalog.base import query
from tablework.functions import clock
from tablework.functions.numbers import safe_ratio
from tablework.operators import calendar, snapshot
from tablework.plans import campaign, sales
from tablework.session import work_path
from tablework.sinks.tables import replace_partition
from tablework.sources import retail

TZ = sql.TZ
AS_OF = retail.ORDERS_AS_OF

DAILY_SALES = f"""
SELECT CAST({sql.local("created_at")} AS DATE) AS sales_date, count(DISTINCT order_id) AS orders,
       CAST(sum(CASE WHEN status NOT IN ('Cancelled', 'Returned') THEN sale_price ELSE 0 END) AS DECIMAL(18,2)) AS net_revenue
FROM r_items GROUP BY 1"""


@query("daily_sales_local", sql.with_ctes(sql.ORDERS, sql.ITEMS, body=DAILY_SALES))
def _(spark, sf_dir):
    return sales.daily_sales(retail.order_items(spark, sf_dir), TZ)


@query("local_time", sql.with_ctes(sql.ORDERS, body=f"""
SELECT order_id, {sql.offset("created_at")} AS offset_minutes, {sql.local("created_at")} AS local_created,
       CAST({sql.local("created_at")} AS DATE) AS local_day, {sql.to_utc("created_at")} AS if_local
FROM r_orders"""))
def _(spark, sf_dir):
    created = F.col("created_at")
    return retail.orders(spark, sf_dir).select(
        "order_id", clock.tz_offset_minutes(created, TZ).alias("offset_minutes"),
        clock.utc_to_local(created, TZ).alias("local_created"), clock.local_date(created, TZ).alias("local_day"),
        clock.local_to_utc(created.cast("timestamp_ntz"), TZ).alias("if_local"))


_TODAY = f"(CAST(CAST({sql.local('created_at')} AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR)"
NEXT_RUN = (f"CASE WHEN {sql.to_utc(_TODAY)} > created_at THEN {sql.to_utc(_TODAY)} "
            f"ELSE {sql.to_utc(f'({_TODAY} + INTERVAL 1 DAY)')} END")


@query("next_run", sql.with_ctes(sql.ORDERS, body=f"SELECT order_id, created_at AS now_utc, {NEXT_RUN} AS next_run FROM r_orders"))
def _(spark, sf_dir):
    return retail.orders(spark, sf_dir).select(
        "order_id", F.col("created_at").alias("now_utc"),
        clock.next_run_utc(F.col("created_at"), "06:00:00", TZ).alias("next_run"))


@query("sql_udf_local_time", sql.with_ctes(sql.ORDERS, body=f"""
SELECT order_id, {sql.offset("created_at")} AS offset_minutes, {sql.to_utc("created_at")} AS if_local, {NEXT_RUN} AS next_run
FROM r_orders"""))
def _(spark, sf_dir):
    clock.register_sql_functions(spark)
    retail.orders(spark, sf_dir).createOrReplaceTempView("clock_orders")
    return spark.sql(f"""
        SELECT order_id, tz_offset_minutes(created_at, '{TZ}') AS offset_minutes,
               local_to_utc(CAST(created_at AS TIMESTAMP_NTZ), '{TZ}') AS if_local,
               next_run_utc(created_at, '06:00:00', '{TZ}') AS next_run
        FROM clock_orders""")


SPINE = """
spine AS (
  SELECT CAST(d AS DATE) AS calendar_date FROM (
    SELECT unnest(generate_series(min(CAST(created_at AS DATE)), DATE '2001-08-02', INTERVAL 1 DAY)) AS d FROM r_orders)
)"""


@query("date_spine", sql.with_ctes(sql.ORDERS, SPINE, body="""
SELECT calendar_date, dayname(calendar_date) AS day_of_week, CAST(dayofweek(calendar_date) + 1 AS INTEGER) AS day_of_week_index,
       dayofweek(calendar_date) IN (0, 6) AS is_weekend, day(calendar_date) <= 2 AS is_month_to_date,
       CAST(date_diff('day', calendar_date, DATE '2001-08-02') AS INTEGER) AS days_ago
FROM spine"""))
def _(spark, sf_dir):
    return calendar.date_spine(retail.orders(spark, sf_dir), AS_OF)


@query("zero_filled_daily", sql.with_ctes(sql.ORDERS, SPINE, body="""
SELECT calendar_date, count(order_id) AS returned_orders
FROM spine LEFT JOIN (SELECT * FROM r_orders WHERE status = 'Returned') ON CAST(created_at AS DATE) = calendar_date
GROUP BY calendar_date"""))
def _(spark, sf_dir):
    orders = retail.orders(spark, sf_dir)
    daily = (orders.filter(F.col("status") == "Returned")
             .groupBy(F.to_date("created_at").alias("calendar_date")).agg(F.count("*").alias("returned_orders")))
    return calendar.zero_filled_daily(calendar.date_spine(orders, AS_OF), daily, ["returned_orders"])


SNAPSHOT = """
snapshot AS (
  SELECT snapshot_date, order_id, user_id,
         CASE WHEN CAST(returned_at AS DATE) <= snapshot_date THEN 'Returned'
              WHEN CAST(delivered_at AS DATE) <= snapshot_date THEN 'Complete'
              WHEN status = 'Cancelled' THEN 'Cancelled'
              WHEN CAST(shipped_at AS DATE) <= snapshot_date THEN 'Shipped'
              ELSE 'Processing' END AS status_on_date,
         CAST(date_diff('day', CAST(created_at AS DATE), snapshot_date) AS INTEGER) AS order_age_days
  FROM (SELECT CAST(unnest(generate_series(DATE '2000-08-02', DATE '2001-08-01', INTERVAL 1 DAY)) AS DATE) AS snapshot_date)
  JOIN (SELECT *, coalesce(CAST(returned_at AS DATE), CAST(delivered_at AS DATE),
                           CASE WHEN status = 'Cancelled' THEN CAST(created_at AS DATE) END) AS final_date FROM r_orders)
    ON CAST(created_at AS DATE) <= snapshot_date AND (final_date IS NULL OR snapshot_date <= final_date + 30)
)"""


@query("order_status_snapshot", sql.with_ctes(sql.ORDERS, SNAPSHOT, body="""
SELECT CAST(snapshot_date AS VARCHAR) || '-' || order_id AS snapshot_key, * FROM snapshot"""))
def _(spark, sf_dir):
    rows = snapshot.order_status_snapshot(retail.orders(spark, sf_dir), AS_OF)
    return rows.select(F.concat(F.col("snapshot_date").cast("string"), F.lit("-"),
                                F.col("order_id").cast("string")).alias("snapshot_key"), "*")


@query("snapshot_append_day", sql.with_ctes(sql.ORDERS, SNAPSHOT, body="""
SELECT * FROM snapshot WHERE snapshot_date = DATE '2001-08-01'"""))
def _(spark, sf_dir):
    day = AS_OF - dt.timedelta(days=1)
    path = work_path(spark, "snapshot")
    rows = snapshot.snapshot_of_day(retail.orders(spark, sf_dir), day)
    replace_partition(rows, path, "snapshot_date", day)
    return spark.read.schema(rows.schema).parquet(path)


CAMPAIGN = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC NULLS LAST, order_id DESC) AS recency FROM r_orders
),
rollup_ AS (
  SELECT user_id, count(*) AS lifetime_orders, count(*) FILTER (status = 'Returned') AS lifetime_returns,
         count(*) FILTER (status IN ('Processing', 'Shipped')) AS open_orders
  FROM r_orders GROUP BY user_id
),
campaign AS (
  SELECT l.user_id, l.order_id AS last_order_id, l.created_at AS last_ordered_at, l.delivered_at AS last_delivered_at,
         CAST(date_diff('day', CAST(l.delivered_at AS DATE), DATE '2001-08-02') AS INTEGER) AS days_since_delivery,
         CAST(v.order_value AS DECIMAL(18,2)) AS last_order_value, r.lifetime_orders, r.lifetime_returns
  FROM ranked l JOIN rollup_ r ON r.user_id = l.user_id
  LEFT JOIN (SELECT order_id, sum(sale_price) AS order_value FROM r_items GROUP BY order_id) v ON v.order_id = l.order_id
  WHERE l.recency = 1 AND l.status = 'Complete'
    AND CAST(l.delivered_at AS DATE) BETWEEN DATE '2001-08-02' - 90 AND DATE '2001-08-02' - 30
    AND r.open_orders = 0 AND r.lifetime_returns / r.lifetime_orders <= 0.5
)"""


@query("repeat_campaign", sql.with_ctes(sql.ORDERS, sql.ITEMS, CAMPAIGN, body="SELECT * FROM campaign"))
def _(spark, sf_dir):
    return campaign.repeat_campaign(retail.orders(spark, sf_dir), retail.order_lines(spark, sf_dir), AS_OF)


@query("semi_join_last_orders", sql.with_ctes(sql.ORDERS, sql.ITEMS, CAMPAIGN, body="""
SELECT order_id, CAST(sum(sale_price) AS DECIMAL(18,2)) AS order_value FROM r_items
WHERE order_id IN (SELECT order_id FROM ranked WHERE recency = 1) GROUP BY order_id"""))
def _(spark, sf_dir):
    last = campaign.last_orders(retail.orders(spark, sf_dir))
    return campaign.last_order_values(retail.order_lines(spark, sf_dir), last).withColumn(
        "order_value", F.col("order_value").cast("decimal(18,2)"))


@query("days_to_deliver", sql.with_ctes(sql.ORDERS, body="""
SELECT order_id, date_sub('day', created_at, delivered_at) AS days_to_deliver, status IN ('Processing', 'Shipped') AS is_open
FROM r_orders"""))
def _(spark, sf_dir):
    return retail.orders(spark, sf_dir).select(
        "order_id", clock.whole_days_between(F.col("created_at"), F.col("delivered_at")).alias("days_to_deliver"),
        F.col("status").isin(*campaign.OPEN_STATUSES).alias("is_open"))


@query("timeframes", sql.with_ctes(sql.EVENTS, body="""
SELECT date_trunc('hour', created_at) AS hour, CAST(created_at AS DATE) AS date,
       CAST(date_trunc('week', created_at) AS DATE) AS week, CAST(date_trunc('month', created_at) AS DATE) AS month,
       CAST(date_trunc('quarter', created_at) AS DATE) AS quarter, CAST(date_trunc('year', created_at) AS DATE) AS year,
       count(*) AS n_events, max(created_at) AS latest
FROM r_events GROUP BY ALL"""))
def _(spark, sf_dir):
    units = ("hour", "date", "week", "month", "quarter", "year")
    return (retail.web_events(spark, sf_dir)
            .groupBy(*[clock.timeframe(F.col("created_at"), u).alias(u) for u in units])
            .agg(F.count("*").alias("n_events"), F.max(clock.timeframe(F.col("created_at"), "raw")).alias("latest")))
