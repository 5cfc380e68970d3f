"""Two daily sales exports derived from the driver tables, all columns text.

They carry the mess a real export has: padding, odd casing, currency text,
blanks, unknown stages, unknown companies, one-digit dates, exact duplicates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.sources.retail import pick, table

FIRST_DAY = dt.date(2001, 7, 31)
AS_OF = dt.date(2001, 8, 2)
AS_OF_TIME = dt.datetime(2001, 8, 2)

STAGES = ("Prospecting", "Discovery", "Proposal", "Negotiation", "Closed Won", "Closed Lost")
PLANS = ("starter", "GROWTH", " enterprise ", "pro-plus")
OWNERS = (" mary-jane watts", "BOB STONE", "dave o'neil", "ana  silva", "", "li wei ")
ACCOUNT_OWNERS = ("mary-jane watts", "BOB STONE ", "ana silva", "")
BANDS = ("1-10", "11-50", "51-200")
COUNTRIES = ("us", " de", "GB", "fr ")


def _metadata(name: str, day: Column) -> list[Column]:
    file_date = F.date_add(F.lit(FIRST_DAY), day - 1)
    return [
        F.concat(F.lit(f"incoming/{name}/{name}_"), file_date.cast("string"), F.lit(".csv")).alias("_source_file"),
        file_date.alias("_file_date"),
        F.timestamp_add("HOUR", F.lit(6), file_date.cast("timestamp")).alias("_loaded_at"),
    ]


def raw_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    ints = lambda *days: F.array(*[F.lit(d) for d in days])
    rows = table(spark, sf_dir, "orders").withColumn(
        "day", F.explode(F.when(k % 60 == 11, ints(1, 1, 2, 2)).otherwise(ints(1, 2))))
    day = F.col("day")
    moved = (k % 5 == 0) & (day == 2)
    name = pick(STAGES, F.when(moved, (k % 6 + 1) % 6).otherwise(k % 6))
    styled = (F.when(k % 3 == 0, F.upper(name))
              .when(k % 3 == 1, F.concat(F.lit(" "), F.replace(F.lower(name), F.lit(" "), F.lit("  ")), F.lit(" ")))
              .otherwise(name))
    ordered = F.to_date("o_orderdate")
    amount = F.floor("o_totalprice").cast("bigint")
    return rows.select(
        F.when(k % 50 == 0, "   ").when(k % 7 == 0, F.concat(F.lit(" D"), k.cast("string")))
        .otherwise(F.concat(F.lit("D"), k.cast("string"))).alias("deal_id"),
        F.when(k % 40 == 1, "").when(k % 40 == 2, "C999999999")
        .otherwise(F.concat(F.lit("C"), F.col("o_custkey").cast("string"))).alias("company_id"),
        F.when(k % 9 == 0, F.concat(F.lit("\u00a0Deal "), k.cast("string"), F.lit("\t")))
        .otherwise(F.concat(F.lit(" Deal "), k.cast("string"))).alias("deal_name"),
        pick(PLANS, k % 4).alias("plan"),
        F.when(k % 97 == 3, "Stalled").when(k % 89 == 4, "").otherwise(styled).alias("stage"),
        F.when(k % 31 == 5, "").when(k % 4 == 0, F.concat(F.lit("$"), F.format_number(amount, 0), F.lit(".00")))
        .otherwise(amount.cast("string")).alias("amount_usd"),
        pick(OWNERS, F.col("o_custkey") % 6).alias("owner"),
        F.when(k % 71 == 6, "n/a").when(k % 6 == 1, F.date_format(ordered, "yyyy-M-d"))
        .otherwise(ordered.cast("string")).alias("created_date"),
        F.when(k % 67 == 5, "").otherwise(F.date_add(ordered, (30 + k % 300).cast("int")).cast("string"))
        .alias("expected_close_date"),
        F.when(k % 83 == 7, "pending").when(moved, "2001-08-01T05:00:00Z")
        .otherwise(F.concat(F.date_add(ordered, (k % 20).cast("int")).cast("string"), F.lit("T08:30:00Z")))
        .alias("last_updated_at"),
        *_metadata("deals", day))


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").withColumn(
        "day", F.explode(F.when(c % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    day = F.col("day")
    return rows.select(
        F.when(c % 55 == 54, " ").otherwise(F.concat(F.lit("C"), c.cast("string"))).alias("company_id"),
        F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit(" \t#"))).alias("company_name"),
        F.when(c % 8 == 7, " ").otherwise(F.col("c_mktsegment")).alias("industry"),
        pick(BANDS, c % 3).alias("employee_band"),
        pick(COUNTRIES, F.col("c_nationkey") % 4).alias("country"),
        pick(ACCOUNT_OWNERS, (c + day) % 4).alias("account_owner"),
        F.when(c % 43 == 9, "soon").otherwise(
            F.date_add(F.lit(dt.date(1994, 1, 1)), (c % 365).cast("int")).cast("string")).alias("created_date"),
        *_metadata("companies", day))
