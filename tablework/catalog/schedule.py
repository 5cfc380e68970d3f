"""Daily-job queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tablework.catalog import shapes_sql as sql
from tablework.catalog.base import query
from tablework.catalog.retail import DAILY_SALES, NEXT_RUN
from tablework.functions.clock import local_date, scheduled_at
from tablework.plans import schedule
from tablework.session import work_path
from tablework.sinks.folders import read_current
from tablework.sources import retail

JOB = schedule.DailyJob("daily_sales_rollup")
RERUN_AT = dt.datetime(2001, 8, 1, 10, 30)


def _job_name():
    return F.concat(F.lit("job-"), (F.col("user_id") % 7).cast("string"))


def order_log(spark, sf_dir):
    """A run log in which each order is one run of its customer's job."""
    orders = retail.orders(spark, sf_dir)
    event = lambda status, at: F.struct(F.lit(status).alias("status"), at.alias("logged_at"))
    events = F.array(event("running", F.col("created_at")), event("success", F.col("delivered_at")),
                     event("failed", F.col("returned_at")))
    run_date = local_date(F.col("created_at"), JOB.tz)
    return (orders.select(_job_name().alias("job_name"), run_date.alias("run_date"),
                          scheduled_at(run_date, JOB.run_time, JOB.tz).alias("scheduled_at"),
                          F.col("created_at").alias("started_at"), F.inline(events))
            .filter(F.col("logged_at").isNotNull()))


RUN_LOG = f"""
log AS (
  SELECT 'job-' || (user_id % 7) AS job_name, CAST({sql.local("created_at")} AS DATE) AS run_date,
         created_at AS started_at, unnest(['running', 'success', 'failed']) AS status,
         unnest([created_at, delivered_at, returned_at]) AS logged_at
  FROM r_orders
),
runs AS (
  SELECT job_name, run_date, status, logged_at FROM (
    SELECT *, row_number() OVER (PARTITION BY job_name, run_date ORDER BY logged_at DESC NULLS LAST,
                                 started_at NULLS FIRST, status NULLS FIRST) AS newest
    FROM log WHERE logged_at IS NOT NULL) WHERE newest = 1
)"""


@query("run_log", sql.with_ctes(sql.ORDERS, RUN_LOG, body="SELECT * FROM runs"))
def _(spark, sf_dir):
    return schedule.current_runs(order_log(spark, sf_dir)).select("job_name", "run_date", "status", "logged_at")


_SIX = "(CAST(local_date AS TIMESTAMP) + INTERVAL 6 HOUR)"


@query("run_guard", sql.with_ctes(sql.ORDERS, RUN_LOG, body=f"""
SELECT order_id, t.job_name, now_ts, local_date, scheduled_at, next_run AS next_run_utc, r.job_name IS NOT NULL AS already_ran,
       CASE WHEN now_ts >= scheduled_at AND now_ts < scheduled_at + INTERVAL 180 MINUTE AND r.job_name IS NULL
            THEN 'run' ELSE 'skip' END AS decision
FROM (SELECT *, {sql.to_utc(_SIX)} AS scheduled_at FROM (
        SELECT order_id, 'job-' || (user_id % 7) AS job_name, created_at AS now_ts,
               CAST({sql.local("created_at")} AS DATE) AS local_date, {NEXT_RUN} AS next_run FROM r_orders)) t
LEFT JOIN (SELECT * FROM runs WHERE status IN ('running', 'success')) r ON r.job_name = t.job_name AND r.run_date = t.local_date"""))
def _(spark, sf_dir):
    triggers = retail.orders(spark, sf_dir).select(
        "order_id", _job_name().alias("job_name"), F.col("created_at").alias("now_ts"),
        F.lit(JOB.run_time).alias("run_time"), F.lit(JOB.tz).alias("tz"),
        F.lit(JOB.catch_up_minutes).alias("catch_up_minutes"))
    return schedule.run_guard(triggers, order_log(spark, sf_dir)).select(
        "order_id", "job_name", "now_ts", "local_date", "scheduled_at", "next_run_utc", "already_ran", "decision")


@query("daily_sales_idempotent", sql.with_ctes(sql.ORDERS, sql.ITEMS, body=DAILY_SALES))
def _(spark, sf_dir):
    path, log = work_path(spark, "daily-sales"), work_path(spark, "run-log")
    items = retail.order_items(spark, sf_dir)
    schedule.backfill_daily_sales(items, path, JOB.tz)
    # The guarded job replaces yesterday; its second trigger must do nothing.
    for now in (RERUN_AT, RERUN_AT + dt.timedelta(hours=1)):
        schedule.run_daily_job(spark, JOB, now, log,
                               lambda day: schedule.load_daily_sales(items, path, day, JOB.tz))
    return read_current(spark, path, schedule.DAILY_SALES_SCHEMA)
