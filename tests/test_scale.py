"""Plans and skew: what must hold when one key has a third of the rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tablework.operators.versions import latest_version
from tablework.plans import campaign, crm

WRITERS = {"publish_reports", "raw_append", "stream_file_drop", "header_gate", "file_outcomes", "csv_drop_scan",
           "sync_state", "sync_idempotent", "sync_report", "sync_dry_run", "daily_sales_idempotent",
           "snapshot_append_day"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - WRITERS))
def test_no_plan_has_a_nested_loop_or_python(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    for bad in ("NestedLoopJoin", "CartesianProduct", "Python", "Pandas", "Scan ExistingRDD"):
        assert bad not in plan, (name, bad)
    # A window keeps one row per key before its shuffle.
    assert plan.count("Window [row_number") <= len(re.findall(r"WindowGroupLimit .* Partial", plan))


def hot(spark, n=60_000):
    """Two thirds of the rows have keys of their own, one third share one."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 8).withColumn("key", key)


def test_hot_key_sends_one_row_per_task_to_the_version_window(spark):
    df = hot(spark).withColumn("v", F.col("id") % 1000)
    result = latest_version(df, ["key"], ["v"])
    assert re.search(r"WindowGroupLimit .* Partial", plan_of(result))
    rows = {r.key: (r.v, r.id) for r in result.filter("key = -1").collect()}
    best = df.filter("key = -1").orderBy(F.desc("v"), "id").first()
    assert rows == {-1: (best.v, best.id)} and result.count() == 40_001


def test_hot_customer_rollup_is_grouped_before_the_shuffle(spark):
    orders = hot(spark).select(
        F.col("id").alias("order_id"), F.col("key").alias("user_id"), F.lit("Complete").alias("status"),
        F.timestamp_seconds("id").alias("created_at"), F.timestamp_seconds("id").alias("delivered_at"))
    rollup = campaign.customer_rollup(orders)
    plan = plan_of(rollup)
    assert plan.count("partial_count") >= 1 and "Window" not in plan
    row = rollup.filter("user_id = -1").first()
    assert row.lifetime_orders == 20_000 and row.last.order_id == 59_997


def test_hot_company_keeps_every_deal(spark):
    deals = hot(spark).select(
        F.col("id").cast("string").alias("deal_id"), F.col("key").cast("string").alias("company_id"),
        F.lit("x").alias("deal_name"), F.lit("p").alias("plan"), F.lit("Proposal").alias("stage"),
        F.lit(1).cast("decimal(38,9)").alias("amount_usd"), F.lit("o").alias("owner"),
        F.lit(dt.date(2026, 1, 1)).alias("created_date"), F.lit(dt.date(2026, 2, 1)).alias("expected_close_date"),
        F.lit(None).cast("timestamp").alias("last_updated_at"), F.lit("f").alias("_source_file"),
        F.lit(False).alias("is_closed"), F.lit(False).alias("is_won"), F.lit(False).alias("is_missing_amount"))
    companies = hot(spark).select(F.col("key").cast("string").alias("company_id"), F.lit("n").alias("company_name"),
                                  F.lit("i").alias("industry"), F.lit("e").alias("employee_band"),
                                  F.lit("US").alias("country_code")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        live = crm.deal_pipeline(deals, dt.date(2026, 3, 1), companies)
        live.collect()
        plan = plan_of(live)
        assert live.filter("company_name = 'n'").count() == 60_000
        assert "skew=true" in plan
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes",
                     "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
