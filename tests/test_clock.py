import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablework.functions import clock

TZ = "America/New_York"

CONVERSIONS = [
    ("2026-03-07 06:00", "2026-03-07 11:00"), ("2026-03-08 06:00", "2026-03-08 10:00"),
    ("2026-10-31 06:00", "2026-10-31 10:00"), ("2026-11-01 06:00", "2026-11-01 11:00"),
    ("2026-03-08 02:30", "2026-03-08 07:30"), ("2026-11-01 01:30", "2026-11-01 05:30"),
    ("2026-03-08 00:00", "2026-03-08 05:00"), ("2026-03-09 00:00", "2026-03-09 04:00"),
    ("2026-11-01 00:00", "2026-11-01 04:00"), ("2026-11-02 00:00", "2026-11-02 05:00"),
]
NEXT_RUNS = [
    ("2026-03-08 10:30", "2026-03-09 10:00"), ("2026-11-01 10:30", "2026-11-01 11:00"),
    ("2026-07-15 03:00", "2026-07-15 10:00"), ("2026-07-15 10:00", "2026-07-16 10:00"),
]


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("local, utc", CONVERSIONS)
def test_local_to_utc(spark, local, utc):
    wall = F.lit(f"{local}:00").cast("timestamp_ntz")
    assert str(value(spark, clock.local_to_utc(wall, TZ).cast("timestamp_ntz")))[:16] == utc
    clock.register_sql_functions(spark)
    sql = spark.sql(f"SELECT CAST(local_to_utc(TIMESTAMP_NTZ '{local}:00', '{TZ}') AS TIMESTAMP_NTZ) AS x")
    assert str(sql.first()["x"])[:16] == utc


@pytest.mark.parametrize("now, expected", NEXT_RUNS)
def test_next_run_is_strictly_after_now(spark, now, expected):
    at = clock.instant(dt.datetime.fromisoformat(now))
    assert str(value(spark, clock.next_run_utc(at, "06:00:00", TZ).cast("timestamp_ntz")))[:16] == expected


def test_offset_and_local_date(spark):
    noon = clock.instant(dt.datetime(2026, 7, 1, 12))
    assert value(spark, clock.tz_offset_minutes(noon, TZ)) == -240
    assert value(spark, clock.local_date(clock.instant(dt.datetime(2026, 7, 15, 3)), TZ)) == dt.date(2026, 7, 14)


def test_local_days_are_23_24_or_25_hours(spark):
    def hours(day):
        edges = F.timestamp_diff("HOUR", clock.local_day_start(day, TZ),
                                 clock.local_day_start(day + dt.timedelta(days=1), TZ))
        return value(spark, edges)
    assert [hours(dt.date(2026, *d)) for d in ((3, 8), (3, 9), (11, 1))] == [23, 24, 25]


def test_timeframes(spark):
    ts = clock.instant(dt.datetime(2026, 8, 12, 13, 45))  # a Wednesday
    found = [str(value(spark, clock.timeframe(ts, u))) for u in ("date", "week", "month", "quarter", "year")]
    assert found == ["2026-08-12", "2026-08-10", "2026-08-01", "2026-07-01", "2026-01-01"]
    with pytest.raises(ValueError):
        clock.timeframe(ts, "decade")


def test_whole_days_are_24_hour_periods(spark):
    start = clock.instant(dt.datetime(2026, 1, 1, 12))
    assert value(spark, clock.whole_days_between(start, clock.instant(dt.datetime(2026, 1, 2, 11, 59)))) == 0
    assert value(spark, clock.whole_days_between(start, clock.instant(dt.datetime(2026, 1, 2, 12)))) == 1
