"""Replication queries."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import functions as F

from tablework.catalog import shapes_sql as sql
from tablework.catalog.base import query
from tablework.operators.merge import keys_gone_from_source, merge_upsert
from tablework.plans import replicate
from tablework.session import work_path
from tablework.sinks.folders import read_current
from tablework.sources import retail

NOW = dt.datetime(2001, 8, 2)
SINCE = dt.datetime(2001, 7, 20)
MILESTONES = ("created_at", "shipped_at", "delivered_at", "returned_at")

ORDERS, ITEMS, USERS, PRODUCTS, CENTERS = replicate.table_syncs([
    {"name": "orders", "mode": "incremental", "primary_key": ["order_id"], "watermark": MILESTONES,
     "lookback_minutes": 120,
     "columns": ["order_id", "user_id", "status", "gender", *MILESTONES, "num_of_item"]},
    {"name": "order_items", "mode": "incremental", "primary_key": ["id"], "watermark": MILESTONES,
     "lookback_minutes": 120,
     "columns": ["id", "order_id", "user_id", "product_id", "inventory_item_id", "status", *MILESTONES,
                 "sale_price"]},
    {"name": "users", "mode": "incremental", "primary_key": ["id"], "watermark": ["created_at"],
     "lookback_minutes": 60,
     "columns": ["id", "first_name", "last_name", "email", "age", "gender", "state", "city", "country",
                 "postal_code", "traffic_source", "created_at"]},
    {"name": "products", "mode": "full", "primary_key": ["id"],
     "columns": ["id", "cost", "category", "name", "brand", "retail_price", "department", "sku",
                 "distribution_center_id"]},
    {"name": "distribution_centers", "mode": "full", "primary_key": ["id"],
     "columns": ["id", "name", "latitude", "longitude"]},
])


def sources(spark, sf_dir):
    return {"orders": partial(retail.orders, spark, sf_dir, with_item_count=True),
            "order_items": partial(retail.order_items, spark, sf_dir),
            "users": partial(retail.users, spark, sf_dir), "products": partial(retail.products, spark, sf_dir),
            "distribution_centers": partial(retail.distribution_centers, spark, sf_dir)}


def _earlier(orders):
    """The orders as a target saw them before ``SINCE``: open, milestones unknown."""
    return orders.filter(F.col("created_at") < F.lit(SINCE.date())).withColumns({
        "status": F.lit("Processing"), **{c: F.lit(None).cast("timestamp") for c in MILESTONES[1:]}})


WATERMARK = "greatest(created_at, shipped_at, delivered_at, returned_at)"
CHANGED = f"""
changed AS (SELECT *, {WATERMARK} AS _watermark FROM r_orders
            WHERE {WATERMARK} > TIMESTAMP '2001-07-20 00:00:00' - INTERVAL 120 MINUTE)"""
_ORDER_COLUMNS = "order_id, user_id, status, gender, created_at, shipped_at, delivered_at, returned_at, num_of_item"


@query("sync_full", sql.with_ctes(sql.PRODUCTS, body="""
SELECT id, cost, category, name, brand, retail_price, department, sku, distribution_center_id FROM r_products"""))
def _(spark, sf_dir):
    return replicate.changed_rows(retail.products(spark, sf_dir), PRODUCTS, SINCE).drop("_watermark")


@query("sync_incremental", sql.with_ctes(sql.ORDERS, CHANGED, body=f"SELECT {_ORDER_COLUMNS}, _watermark FROM changed"))
def _(spark, sf_dir):
    return replicate.changed_rows(sources(spark, sf_dir)["orders"](), ORDERS, SINCE)


@query("upsert_merge", sql.with_ctes(sql.ORDERS, CHANGED, body=f"""
SELECT {_ORDER_COLUMNS} FROM changed
UNION ALL
SELECT order_id, user_id, 'Processing', gender, created_at, NULL, NULL, NULL, num_of_item FROM r_orders
WHERE created_at < TIMESTAMP '2001-07-20 00:00:00' AND order_id NOT IN (SELECT order_id FROM changed)"""))
def _(spark, sf_dir):
    orders = sources(spark, sf_dir)["orders"]()
    updates = replicate.one_per_key(replicate.changed_rows(orders, ORDERS, SINCE), ORDERS)
    return merge_upsert(_earlier(orders).select(*ORDERS.columns), updates, ORDERS.primary_key)


@query("sync_delete_reconcile", sql.with_ctes(sql.ORDERS, body="""
SELECT order_id FROM r_orders WHERE status = 'Cancelled'"""))
def _(spark, sf_dir):
    orders = retail.orders(spark, sf_dir)
    return keys_gone_from_source(orders, orders.filter(F.col("status") != "Cancelled"), ["order_id"])


@query("sync_dry_run", sql.with_ctes(sql.ORDERS, sql.ITEMS, body=f"""
SELECT 'orders' AS "table", count(*) AS "rows", max({WATERMARK}) AS new_watermark, true AS dry_run FROM r_orders
UNION ALL SELECT 'order_items', count(*), max({WATERMARK}), true FROM r_items"""))
def _(spark, sf_dir):
    report = replicate.run_sync(spark, sources(spark, sf_dir), [ORDERS, ITEMS], work_path(spark, "sync"), NOW,
                                dry_run=True)
    return report.select("table", "rows", "new_watermark", "dry_run")


@query("sync_state", sql.with_ctes(sql.ORDERS, body=f"""
SELECT 'orders' AS table_name, max({WATERMARK}) AS watermark,
       count(*) FILTER ({WATERMARK} > (SELECT max({WATERMARK}) FROM r_orders) - INTERVAL 120 MINUTE) AS rows_last_run,
       TIMESTAMP '2001-08-02 00:15:00' AS synced_at FROM r_orders
UNION ALL SELECT 'distribution_centers', TIMESTAMP '2001-08-02 00:15:00', count(*), TIMESTAMP '2001-08-02 00:15:00' FROM supplier"""))
def _(spark, sf_dir):
    root = work_path(spark, "sync")
    for now in (NOW, NOW + dt.timedelta(minutes=15)):
        replicate.run_sync(spark, sources(spark, sf_dir), [ORDERS, CENTERS], root, now, buckets=8)
    return replicate.read_state(spark, root)


@query("sync_idempotent", sql.with_ctes(sql.ORDERS, body=f"SELECT {_ORDER_COLUMNS} FROM r_orders"))
def _(spark, sf_dir):
    root = work_path(spark, "sync")
    orders = sources(spark, sf_dir)["orders"]()
    # An old state of the target, then the same changes twice.
    replicate.upsert_into(spark, f"{root}/orders", _earlier(orders).select(*ORDERS.columns), ["order_id"], 8)
    for _ in range(2):
        changes = replicate.changed_rows(orders, ORDERS, replicate.EPOCH)
        replicate.upsert_into(spark, f"{root}/orders", replicate.one_per_key(changes, ORDERS), ["order_id"], 8)
    return read_current(spark, f"{root}/orders", orders.select(*ORDERS.columns).schema)


@query("sync_report", sql.with_ctes(sql.USERS, sql.PRODUCTS, body="""
SELECT 'users' AS "table", 'incremental' AS mode, count(*) AS "rows", TIMESTAMP '1970-01-01 00:00:00' AS since,
       max(created_at) AS new_watermark, false AS failed FROM r_users
UNION ALL SELECT 'products', 'full', count(*), TIMESTAMP '1970-01-01 00:00:00', NULL, false FROM r_products
UNION ALL SELECT 'missing', 'full', NULL, NULL, NULL, true"""))
def _(spark, sf_dir):
    missing = replicate.TableSync("missing", "full", ("id",), ("id",))
    report = replicate.run_sync(spark, sources(spark, sf_dir), [USERS, missing, PRODUCTS], work_path(spark, "sync"),
                                NOW, buckets=8)
    return report.select("table", "mode", "rows", "since", "new_watermark", F.col("error").isNotNull().alias("failed"))
