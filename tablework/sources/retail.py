"""Online-retailer shapes of the driver tables.

Everything here is a narrow projection, except the joins that carry order
columns onto lines and place names onto users. The order of each table's rows
and its partitioning are the source's own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.clock import instant

ORDERS_AS_OF = dt.date(2001, 8, 2)
INVENTORY_AS_OF = dt.date(2001, 12, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)

OPEN_SINCE = dt.datetime(2001, 7, 15)
TRAFFIC_SOURCES = ("Search", "Organic", "Facebook", "Email", "Display")
BROWSERS = ("Chrome", "Firefox", "Safari")


# Schemas are given, so no footer is read at planning time. Zone-less
# timestamps are read as UTC instants.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    """The value at a zero-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def plus(ts: Column, unit: str, amount: Column) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), ts)


def orders(spark: SparkSession, sf_dir: str, with_item_count: bool = False) -> DataFrame:
    """One row per order. Counting the lines costs a shuffle, so it is asked for."""
    key = F.col("o_orderkey")
    created = plus(F.col("o_orderdate"), "HOUR", (key * 7) % 24)
    status = (F.when(F.col("o_orderdate") > instant(OPEN_SINCE),
                     F.when(key % 2 == 0, "Processing").otherwise("Shipped"))
              .when(F.col("o_orderpriority") == "5-LOW", "Cancelled")
              .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Returned")
              .otherwise("Complete"))
    df = (table(spark, sf_dir, "orders")
          .select(key.alias("order_id"), F.col("o_custkey").alias("user_id"), status.alias("status"),
                  F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                  created.alias("created_at")))
    key = F.col("order_id")
    df = df.withColumns({
        "shipped_at": F.when(F.col("status").isin("Shipped", "Complete", "Returned"),
                             plus(F.col("created_at"), "DAY", 1 + key % 3)),
        "delivered_at": F.when(F.col("status").isin("Complete", "Returned"),
                               plus(F.col("created_at"), "DAY", 3 + key % 7)),
        "returned_at": F.when(F.col("status") == "Returned",
                              plus(F.col("created_at"), "DAY", 12 + key % 9)),
    })
    if with_item_count:
        lines = (table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
                 .agg(F.count("*").cast("int").alias("num_of_item")))
        df = df.join(lines, "order_id", "left").withColumn("num_of_item", F.coalesce("num_of_item", F.lit(0)))
    return df


_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")


def _line_key() -> Column:
    """The digest of ``_line_id`` as two numbers: half as wide in a shuffle."""
    return F.struct(F.xxhash64(*_LINE).alias("high"), F.xxhash64(F.lit(1), *_LINE).alias("low"))


def _line_id() -> Column:
    """A 128-bit digest of the whole line: lines have no unique key, but no two are equal.

    It is a narrow expression, where numbering the lines of an order would pull
    each order into one task.
    """
    return F.concat(F.hex(F.xxhash64(*_LINE)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *_LINE)))


def _sale_price() -> Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


def order_lines(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """The line columns alone, for work that needs nothing from the order. ``line_key`` names a line as its id does."""
    key = [_line_key().alias("line_key")] if with_key else []
    return (table(spark, sf_dir, "lineitem")
            .select(_line_id().alias("id"), F.col("l_orderkey").alias("order_id"),
                    F.col("l_partkey").alias("product_id"), _line_id().alias("inventory_item_id"),
                    _sale_price().alias("sale_price"), *key))


def order_items(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """One row per line, with the status and milestones of its order."""
    headers = orders(spark, sf_dir).drop("gender")
    return order_lines(spark, sf_dir, with_key).join(headers, "order_id").select(
        "id", "order_id", "user_id", "product_id", "inventory_item_id", "status",
        "created_at", "shipped_at", "delivered_at", "returned_at", "sale_price", *(["line_key"] if with_key else []))


def inventory_items(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """One physical unit per line; it is in stock until its line is filled."""
    key = [_line_key().alias("line_key")] if with_key else []
    return (table(spark, sf_dir, "lineitem")
            .select(_line_id().alias("id"), F.col("l_partkey").alias("product_id"),
                    (F.col("l_partkey") % 100).alias("product_distribution_center_id"),
                    F.round(_sale_price() * F.lit(0.6).cast("decimal(2,1)"), 2).cast("decimal(12,2)").alias("cost"),
                    plus(F.col("l_shipdate"), "DAY", -(F.col("l_partkey") % 200)).alias("created_at"),
                    F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("sold_at"), *key))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    price = (F.col("p_size") * 4).cast("decimal(12,4)")
    return (table(spark, sf_dir, "part")
            .select(key.alias("id"),
                    (F.col("p_size") * F.lit(2.2).cast("decimal(2,1)")).cast("decimal(12,4)").alias("cost"),
                    F.col("p_type").alias("category"), F.col("p_name").alias("name"),
                    F.col("p_brand").alias("brand"), price.alias("retail_price"),
                    F.when(key % 2 == 0, "Women").otherwise("Men").alias("department"),
                    F.concat(F.lit("SKU-"), key.cast("string")).alias("sku"),
                    (key % 100).alias("distribution_center_id")))


def distribution_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (table(spark, sf_dir, "supplier")
            .select(key.alias("id"), F.col("s_name").alias("name"),
                    (30 + key).cast("double").alias("latitude"), (-80 - key).cast("double").alias("longitude")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    start = instant(dt.datetime(1994, 1, 1))
    return (table(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(key.alias("id"), F.lit("Customer").alias("first_name"),
                    F.substring("c_name", 10, 20).alias("last_name"),
                    F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
                    (18 + key % 60).cast("int").alias("age"),
                    F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
                    F.col("r_name").alias("state"),
                    F.concat(F.lit("City "), (key % 100).cast("string")).alias("city"),
                    F.col("n_name").alias("country"),
                    F.concat(F.lit("P"), (key % 1000).cast("string")).alias("postal_code"),
                    (key % 90).cast("double").alias("latitude"), (key % 180).cast("double").alias("longitude"),
                    pick(TRAFFIC_SOURCES, key % 5).alias("traffic_source"),
                    plus(start, "DAY", key % 365).alias("created_at")))


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream; every twentieth event is from an anonymous visitor."""
    key = F.col("event_id")
    return (table(spark, sf_dir, "events")
            .select(key.alias("id"), F.when(key % 20 != 0, F.col("user_id")).alias("user_id"),
                    F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string"))
                    .alias("session_id"),
                    (1 + key % 7).cast("int").alias("sequence_number"), "event_type",
                    F.concat(F.lit("/"), F.col("event_type")).alias("uri"),
                    pick(BROWSERS, key % 3).alias("browser"),
                    pick(TRAFFIC_SOURCES, F.col("user_id") % 5).alias("traffic_source"),
                    F.concat(F.lit("City "), (F.col("user_id") % 100).cast("string")).alias("city"),
                    F.concat(F.lit("State "), (F.col("user_id") % 50).cast("string")).alias("state"),
                    F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")).alias("ip_address"),
                    F.col("ts").alias("created_at")))
