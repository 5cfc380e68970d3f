import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablework.functions.clock import instant
from tablework.plans import schedule
from tablework.sinks import folders
from tablework.sinks.folders import read_current

JOB = schedule.DailyJob("rollup")
DAY = dt.date(2026, 3, 8)  # 06:00 in New York is 10:00 UTC


def decide(spark, now, *logged):
    log = spark.createDataFrame(
        [(JOB.name, DAY, None, None, status, dt.datetime(2026, 3, 8, 9, i, tzinfo=dt.timezone.utc))
         for i, status in enumerate(logged)], schedule.RUN_LOG_SCHEMA)
    trigger = spark.range(1).select(
        F.lit(JOB.name).alias("job_name"), instant(dt.datetime.fromisoformat(now)).alias("now_ts"),
        F.lit(JOB.run_time).alias("run_time"), F.lit(JOB.tz).alias("tz"),
        F.lit(JOB.catch_up_minutes).alias("catch_up_minutes"))
    return schedule.run_guard(trigger, log).first().decision


@pytest.mark.parametrize("now, logged, decision", [
    ("2026-03-08 09:59", (), "skip"), ("2026-03-08 10:00", (), "run"), ("2026-03-08 12:59", (), "run"),
    ("2026-03-08 13:00", (), "skip"), ("2026-03-08 10:30", ("running",), "skip"),
    ("2026-03-08 10:30", ("running", "success"), "skip"), ("2026-03-08 10:30", ("running", "failed"), "run"),
    ("2026-03-08 10:30", ("running", "failed", "running"), "skip")])
def test_guard(spark, now, logged, decision):
    assert decide(spark, now, *logged) == decision


def statuses(spark, log):
    return [r.status for r in schedule.read_run_log(spark, log).orderBy("logged_at").collect()]


def test_a_day_runs_once_and_a_failed_day_may_run_again(spark, tmp_path):
    log, days = str(tmp_path / "log"), []

    def fail(day):
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError, match="broken"):
        schedule.run_daily_job(spark, JOB, dt.datetime(2026, 3, 8, 10), log, fail)
    assert statuses(spark, log) == ["running", "failed"]
    for hour in (11, 12):
        schedule.run_daily_job(spark, JOB, dt.datetime(2026, 3, 8, hour), log, days.append)
    assert days == [dt.date(2026, 3, 7)]
    assert statuses(spark, log) == ["running", "failed", "running", "success"]


def test_reloading_a_day_replaces_it_and_an_empty_day_clears_it(spark, tmp_path):
    path = str(tmp_path / "sales")

    def items(*rows):
        return spark.createDataFrame(
            [(o, "Complete", dt.datetime.fromisoformat(t).replace(tzinfo=dt.timezone.utc), p) for o, t, p in rows],
            "order_id bigint, status string, created_at timestamp, sale_price int")

    def table():
        return {str(r.sales_date): float(r.net_revenue)
                for r in read_current(spark, path, schedule.DAILY_SALES_SCHEMA).collect()}

    schedule.backfill_daily_sales(items((1, "2026-03-07 12:00", 5), (2, "2026-03-06 12:00", 7)), path, JOB.tz)
    assert table() == {"2026-03-07": 5.0, "2026-03-06": 7.0}
    for _ in range(2):
        schedule.load_daily_sales(items((1, "2026-03-07 12:00", 6)), path, dt.date(2026, 3, 7), JOB.tz)
    assert table() == {"2026-03-07": 6.0, "2026-03-06": 7.0}
    schedule.load_daily_sales(items(), path, dt.date(2026, 3, 7), JOB.tz)
    assert table() == {"2026-03-06": 7.0}
    schedule.load_daily_sales(items((9, "2026-04-02 12:00", 1)), path, dt.date(2026, 4, 2), JOB.tz)
    assert table() == {"2026-03-06": 7.0, "2026-04-02": 1.0}


@pytest.mark.parametrize("step", ["spread_by", "_children", "_write_text", "_rename_over"])
def test_a_daily_load_that_stops_changes_nothing(spark, tmp_path, monkeypatch, step):
    path, day = str(tmp_path / "sales"), dt.date(2026, 3, 7)

    def items(price):
        at = [dt.datetime(2026, 3, d, 12, tzinfo=dt.timezone.utc) for d in (6, 7)]
        return spark.createDataFrame([(i, "Complete", t, price) for i, t in enumerate(at)],
                                     "order_id bigint, status string, created_at timestamp, sale_price int")

    def table():
        return {str(r.sales_date): float(r.net_revenue)
                for r in read_current(spark, path, schedule.DAILY_SALES_SCHEMA).collect()}

    def stop(*args):
        raise RuntimeError("stopped")

    schedule.backfill_daily_sales(items(5), path, JOB.tz)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="stopped"):
        patch.setattr(folders, step, stop)
        schedule.load_daily_sales(items(6), path, day, JOB.tz)
    assert table() == {"2026-03-06": 5.0, "2026-03-07": 5.0}
    schedule.load_daily_sales(items(6), path, day, JOB.tz)
    assert table() == {"2026-03-06": 5.0, "2026-03-07": 6.0}
