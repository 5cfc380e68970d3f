import datetime as dt

from pyspark.sql import functions as F

from tablework.operators import calendar, snapshot
from tablework.plans import campaign, sales
from tablework.sources import retail

ORDERS = ("order_id bigint, user_id bigint, status string, created_at timestamp, shipped_at timestamp, "
          "delivered_at timestamp, returned_at timestamp")


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc) if text else None


def orders_of(spark, *rows):
    return spark.createDataFrame([(i, u, s, *map(at, times)) for i, u, s, *times in rows], ORDERS)


def test_snapshot_equals_the_range_join(spark, sf_dir):
    as_of = retail.ORDERS_AS_OF
    orders = retail.orders(spark, sf_dir)
    days = spark.range(1).select(F.explode(calendar.days_between(
        F.lit(as_of - dt.timedelta(days=365)), F.lit(as_of - dt.timedelta(days=1)))).alias("d"))
    final = F.coalesce(F.to_date("returned_at"), F.to_date("delivered_at"),
                       F.when(F.col("status") == "Cancelled", F.to_date("created_at")))
    joined = days.join(orders.withColumn("final", final), (F.to_date("created_at") <= F.col("d"))
                       & (F.col("final").isNull() | (F.col("d") <= F.date_add("final", 30))))
    expected = {(r.d, r.order_id) for r in joined.select("d", "order_id").collect()}
    found = [(r.snapshot_date, r.order_id) for r in snapshot.order_status_snapshot(orders, as_of).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_snapshot_status_follows_milestones(spark):
    orders = orders_of(
        spark, (1, 1, "Returned", "2026-01-01 10:00", "2026-01-02", "2026-01-04", "2026-01-06"),
        (2, 1, "Cancelled", "2026-01-03", "2026-01-04", None, None), (3, 1, "Shipped", None, "2026-01-04", None, None))
    rows = snapshot.order_status_snapshot(orders, dt.date(2026, 1, 8)).collect()
    by_day = {(r.order_id, r.snapshot_date.day): r.status_on_date for r in rows}
    assert [by_day[(1, d)] for d in range(1, 8)] == [
        "Processing", "Shipped", "Shipped", "Complete", "Complete", "Returned", "Returned"]
    assert by_day[(2, 5)] == "Cancelled" and not any(k[0] == 3 for k in by_day)


def test_snapshot_stops_thirty_days_after_the_final_state(spark):
    orders = orders_of(spark, (1, 1, "Complete", "2026-01-01", "2026-01-02", "2026-01-03", None))
    last = max(r.snapshot_date for r in snapshot.order_status_snapshot(orders, dt.date(2026, 6, 1)).collect())
    assert last == dt.date(2026, 2, 2)


def test_one_day_equals_that_day_of_the_whole(spark, sf_dir):
    orders = retail.orders(spark, sf_dir)
    day = retail.ORDERS_AS_OF - dt.timedelta(days=1)
    whole = snapshot.order_status_snapshot(orders, retail.ORDERS_AS_OF).filter(F.col("snapshot_date") == F.lit(day))
    assert sorted(snapshot.snapshot_of_day(orders, day).collect()) == sorted(whole.collect())


def test_spine_of_no_orders_is_empty(spark):
    assert calendar.date_spine(orders_of(spark), dt.date(2026, 1, 1)).count() == 0
    late = orders_of(spark, (1, 1, "Complete", "2026-02-01", None, None, None))
    assert calendar.date_spine(late, dt.date(2026, 1, 1)).count() == 0


def test_campaign_rules(spark):
    as_of = dt.date(2026, 6, 1)
    ok = ("2026-04-01", "2026-04-02", "2026-04-10", None)
    orders = orders_of(
        spark,
        (1, 1, "Complete", *ok),
        (2, 2, "Complete", *ok), (3, 2, "Shipped", "2026-03-01", "2026-03-02", None, None),     # open order
        (4, 3, "Complete", "2026-01-01", "2026-01-02", "2026-03-01", None),                     # too long ago
        (5, 4, "Complete", *ok), (6, 4, "Returned", "2026-03-01", "2026-03-02", "2026-03-03", "2026-03-09"),
        (7, 5, "Complete", *ok), (8, 5, "Cancelled", "2026-05-01", None, None, None),           # newest not complete
        (9, 6, "Complete", "2026-03-03", "2026-03-03", "2026-03-03", None),                     # exactly 90 days
        (10, 7, "Complete", "2026-05-01", "2026-05-01", "2026-05-02", None),                    # exactly 30 days
    )
    items = spark.createDataFrame([(1, "10.00"), (1, "5.50"), (9, "1.00")], "order_id bigint, p string").select(
        "order_id", F.col("p").cast("decimal(12,2)").alias("sale_price"))
    rows = {r.user_id: r for r in campaign.repeat_campaign(orders, items, as_of).collect()}
    assert set(rows) == {1, 4, 6, 7}
    assert float(rows[1].last_order_value) == 15.5 and rows[4].last_order_value is None
    assert (rows[6].days_since_delivery, rows[7].days_since_delivery) == (90, 30)


def test_daily_sales_of_one_local_day(spark):
    rows = [(1, "Complete", "2026-03-08 04:59", 1), (2, "Complete", "2026-03-08 05:00", 2),
            (2, "Returned", "2026-03-09 03:59", 4), (3, "Complete", "2026-03-09 04:00", 8)]
    items = spark.createDataFrame([(o, s, at(t), p) for o, s, t, p in rows],
                                  "order_id bigint, status string, created_at timestamp, sale_price int")
    found = sales.daily_sales_of(items, dt.date(2026, 3, 8), "America/New_York").collect()
    assert [(str(r.sales_date), r.orders, float(r.net_revenue)) for r in found] == [("2026-03-08", 1, 2.0)]
