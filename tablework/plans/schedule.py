"""Run a daily job once per local day: guard, run log, idempotent load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.clock import instant, local_date, next_run_utc, scheduled_at
from tablework.operators.joins import lookup
from tablework.operators.versions import latest_version
from tablework.plans.replicate import read_table
from tablework.plans.sales import daily_sales, daily_sales_of
from tablework.sinks.folders import Manifest, read_manifest, read_parts, replace_parts

RUN_LOG_SCHEMA = ("job_name string, run_date date, scheduled_at timestamp, started_at timestamp, "
                  "status string, logged_at timestamp")
DAILY_SALES_SCHEMA = "sales_date date, orders bigint, net_revenue decimal(18,2)"
DONE_OR_BUSY = ("running", "success")
MONTHS = {"column": "sales_month"}


@dataclass(frozen=True)
class DailyJob:
    name: str
    tz: str = "America/New_York"
    run_time: str = "06:00:00"
    catch_up_minutes: int = 180


def current_runs(run_log: DataFrame) -> DataFrame:
    """Latest logged status per job and local date."""
    return latest_version(run_log, ["job_name", "run_date"], ["logged_at"])


def run_guard(triggers: DataFrame, run_log: DataFrame) -> DataFrame:
    """Decide for each trigger whether the job runs now.

    ``triggers`` has job_name, now_ts, run_time, tz and catch_up_minutes. A job
    runs from its scheduled instant, within the catch-up window, if its local
    date has no run that is busy or done. The local date is what keeps a clock
    change from running a day twice or never.
    """
    now, tz = F.col("now_ts"), F.col("tz")
    timed = triggers.withColumn("local_date", local_date(now, tz)).withColumns({
        "scheduled_at": scheduled_at(F.col("local_date"), F.col("run_time"), tz),
        "next_run_utc": next_run_utc(now, F.col("run_time"), tz)})
    busy = (current_runs(run_log).filter(F.col("status").isin(*DONE_OR_BUSY))
            .select("job_name", F.col("run_date").alias("local_date"), F.lit(True).alias("ran")))
    seen = lookup(timed, busy, ["job_name", "local_date"]).withColumn("already_ran", F.col("ran").isNotNull())
    window_end = F.timestamp_add("MINUTE", F.col("catch_up_minutes").cast("int"), F.col("scheduled_at"))
    runs = (now >= F.col("scheduled_at")) & (now < window_end) & ~F.col("already_ran")
    return seen.select(*triggers.columns, F.when(runs, "run").otherwise("skip").alias("decision"),
                       "local_date", "scheduled_at", "next_run_utc", "already_ran")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    log = read_table(spark, path, RUN_LOG_SCHEMA)
    return spark.createDataFrame([], RUN_LOG_SCHEMA) if log is None else log


def log_run(spark: SparkSession, path: str, decision, status: str, logged_at: dt.datetime) -> None:
    row = spark.range(1).select(
        F.lit(decision["job_name"]).alias("job_name"), F.lit(decision["local_date"]).alias("run_date"),
        instant(decision["scheduled_at"]).alias("scheduled_at"), instant(decision["now_ts"]).alias("started_at"),
        F.lit(status).alias("status"), instant(logged_at).alias("logged_at"))
    row.write.mode("append").parquet(path)


def run_daily_job(spark: SparkSession, job: DailyJob, now: dt.datetime, log_path: str,
                  work: Callable[[dt.date], None]) -> dict:
    """Guard, claim, run, record. ``work`` gets the local date before today's.

    One writer at a time is assumed, as the claim is not atomic. An error is
    recorded and raised again; the day may then be retried.
    """
    trigger = spark.range(1).select(
        F.lit(job.name).alias("job_name"), instant(now).alias("now_ts"), F.lit(job.run_time).alias("run_time"),
        F.lit(job.tz).alias("tz"), F.lit(job.catch_up_minutes).alias("catch_up_minutes"))
    decided = run_guard(trigger, read_run_log(spark, log_path))
    decision = decided.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (
        "now_ts", "scheduled_at", "next_run_utc")}).first().asDict()
    if decision["decision"] == "skip":
        return decision
    log_run(spark, log_path, decision, "running", now)
    try:
        work(decision["local_date"] - dt.timedelta(days=1))
    except Exception:
        log_run(spark, log_path, decision, "failed", now + dt.timedelta(microseconds=1))
        raise
    log_run(spark, log_path, decision, "success", now + dt.timedelta(microseconds=1))
    return decision


def backfill_daily_sales(items: DataFrame, path: str, tz: str) -> None:
    """Load every local date. The table has one row a day, so a folder holds a month."""
    rows = daily_sales(items, tz).withColumn("sales_month", F.to_date(F.trunc("sales_date", "MM")))
    replace_parts(rows, path, "sales_month", read_manifest(items.sparkSession, path) or Manifest(MONTHS))


def load_daily_sales(items: DataFrame, path: str, day: dt.date, tz: str) -> None:
    """Replace one local date: its old row goes, also when the day has no sales.

    The month, at most 31 rows, is written anew beside the old one, which stays
    the table's until one rename puts the new one in its place.
    """
    spark, month = items.sparkSession, day.replace(day=1)
    current = read_manifest(spark, path) or Manifest(MONTHS)
    old = read_parts(spark, path, DAILY_SALES_SCHEMA, current, [month.isoformat()])
    rows = old.filter(F.col("sales_date") != F.lit(day)).unionByName(daily_sales_of(items, day, tz))
    replace_parts(rows.withColumn("sales_month", F.lit(month)), path, "sales_month", current, gone=[month.isoformat()])
