"""Local wall-clock time and UTC instants. Expects a session pinned to UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def instant(moment: dt.datetime) -> Column:
    """A timestamp literal; a datetime without a zone is taken as UTC.

    A plain literal would go through the zone of the machine the driver is on.
    """
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc))


def _zone(tz: str | Column) -> Column:
    return tz if isinstance(tz, Column) else F.lit(tz)


def utc_to_local(ts: Column, tz: str | Column) -> Column:
    """The wall clock in ``tz`` at an instant (a timestamp without a zone)."""
    return F.from_utc_timestamp(ts, _zone(tz)).cast("timestamp_ntz")


def local_date(ts: Column, tz: str | Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, _zone(tz)))


def local_to_utc(local: Column, tz: str | Column) -> Column:
    """Instant of a wall-clock time.

    A time that happens twice means its first occurrence; a time that is
    skipped moves forward by the length of the gap.
    """
    return F.to_utc_timestamp(local.cast("timestamp"), _zone(tz))


def tz_offset_minutes(ts: Column, tz: str | Column) -> Column:
    return F.timestamp_diff("MINUTE", ts, F.from_utc_timestamp(ts, _zone(tz)))


def at_time(day: Column, time_of_day: str | Column) -> Column:
    """Wall-clock timestamp of a date and a ``HH:mm:ss`` text."""
    clock = time_of_day if isinstance(time_of_day, Column) else F.lit(time_of_day)
    return F.to_timestamp_ntz(F.concat(day.cast("string"), F.lit(" "), clock),
                              F.lit("yyyy-MM-dd HH:mm:ss"))


def scheduled_at(day: Column, time_of_day: str | Column, tz: str | Column) -> Column:
    return local_to_utc(at_time(day, time_of_day), tz)


def next_run_utc(now: Column, time_of_day: str | Column, tz: str | Column) -> Column:
    """First scheduled instant strictly after ``now``."""
    today = local_date(now, tz)
    run = scheduled_at(today, time_of_day, tz)
    return F.when(run > now, run).otherwise(scheduled_at(F.date_add(today, 1), time_of_day, tz))


def local_day_start(day: dt.date, tz: str) -> Column:
    """Instant of local midnight at the start of ``day``; folds to a literal."""
    return scheduled_at(F.lit(day), "00:00:00", tz)


def whole_days_between(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``."""
    return F.timestamp_diff("DAY", start, end)


def timeframe(ts: Column, unit: str) -> Column:
    """One of raw, hour, date, week, month, quarter, year. Weeks start on Monday."""
    if unit == "raw":
        return ts
    if unit == "hour":
        return F.date_trunc("hour", ts)
    if unit == "date":
        return F.to_date(ts)
    if unit in ("week", "month", "quarter", "year"):
        return F.to_date(F.date_trunc(unit, ts))
    raise ValueError(f"unknown timeframe: {unit}")


def utc_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm 'UTC'")


def register_sql_functions(spark: SparkSession) -> None:
    """The same three functions for callers who write SQL."""
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION tz_offset_minutes(ts TIMESTAMP, tz STRING) RETURNS BIGINT
        RETURN timestampdiff(MINUTE, ts, from_utc_timestamp(ts, tz))""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION local_to_utc(local_dt TIMESTAMP_NTZ, tz STRING) RETURNS TIMESTAMP
        RETURN to_utc_timestamp(CAST(local_dt AS TIMESTAMP), tz)""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION next_run_utc(now_ts TIMESTAMP, run_time STRING, tz STRING)
        RETURNS TIMESTAMP
        RETURN CASE
            WHEN to_utc_timestamp(to_timestamp(concat(to_date(from_utc_timestamp(now_ts, tz)), ' ', run_time)), tz) > now_ts
            THEN to_utc_timestamp(to_timestamp(concat(to_date(from_utc_timestamp(now_ts, tz)), ' ', run_time)), tz)
            ELSE to_utc_timestamp(to_timestamp(concat(date_add(to_date(from_utc_timestamp(now_ts, tz)), 1), ' ', run_time)), tz)
        END""")
