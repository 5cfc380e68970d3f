"""File-drop queries. The dropped files are written from the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.catalog import shapes_sql as sql
from tablework.catalog.base import query
from tablework.plans import ingest
from tablework.session import work_path
from tablework.sources import crm_drops, csv_drop, retail
from tablework.streaming.file_drop import start_file_drop

LOADED_AT = dt.datetime(2001, 8, 1, 6)


def drop_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the two exports of each table as CSV files; returns the drop folder.

    The rows are spread first, so that a drop is several files, as a real one is.
    They are dealt by their place: dealing them in turn would sort each task's rows in memory.
    """
    root = work_path(spark, "drop")
    n_files = spark.sparkContext.defaultParallelism
    for table, rows in (("deals", crm_drops.raw_deals(spark, sf_dir)),
                        ("companies", crm_drops.raw_companies(spark, sf_dir))):
        (rows.select(*csv_drop.EXPECTED_COLUMNS[table], F.monotonically_increasing_id().alias("_place"))
         .repartition(n_files, "_place").drop("_place").write.option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{root}/incoming/{table}"))
    return root


def _blank_as_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in df.columns])


_DEAL_TEXTS = ", ".join(f"nullif({c}, '') AS {c}" for c in csv_drop.EXPECTED_COLUMNS["deals"])
_COMPANY_TEXTS = ", ".join(f"nullif({c}, '') AS {c}" for c in csv_drop.EXPECTED_COLUMNS["companies"])


@query("csv_drop_scan", sql.with_ctes(sql.RAW_DEALS, body=f"SELECT {_DEAL_TEXTS} FROM raw_deals"))
def _(spark, sf_dir):
    root = drop_files(spark, sf_dir)
    return _blank_as_null(csv_drop.csv_drop(spark, [f"{root}/incoming/deals"], "deals").drop("_source_file"))


@query("raw_append", sql.with_ctes(sql.RAW_COMPANIES, body=f"""
SELECT {_COMPANY_TEXTS}, DATE '2001-08-01' AS _load_date, TIMESTAMP '2001-08-01 06:00:00' AS _loaded_at FROM raw_companies"""))
def _(spark, sf_dir):
    root, warehouse = drop_files(spark, sf_dir), work_path(spark, "warehouse")
    for run in ("first", "again"):  # the second run finds every file loaded
        ingest.load_drop(spark, root, warehouse, LOADED_AT, run)
    raw = ingest.read_raw(spark, warehouse, "companies")
    texts = [F.nullif(F.col(c), F.lit("")).alias(c) for c in csv_drop.EXPECTED_COLUMNS["companies"]]
    return raw.select(*texts, "_load_date", "_loaded_at")


@query("stream_file_drop", sql.with_ctes(sql.RAW_DEALS, sql.RAW_COMPANIES, body="""
SELECT 'deals' AS target_table, count(*) AS n_rows FROM raw_deals
UNION ALL SELECT 'companies', count(*) FROM raw_companies"""))
def _(spark, sf_dir):
    root, warehouse = drop_files(spark, sf_dir), work_path(spark, "warehouse")
    for _ in range(2):  # the second start has nothing left to do
        start_file_drop(spark, root, warehouse, f"{warehouse}/checkpoint", lambda: LOADED_AT).awaitTermination()
    counts = [ingest.read_raw(spark, warehouse, table).agg(F.count("*").alias("n_rows"))
              .select(F.lit(table).alias("target_table"), "n_rows") for table in csv_drop.EXPECTED_COLUMNS]
    return counts[0].unionByName(counts[1])


def _mixed_outcomes(spark, sf_dir):
    """Good files, plus the companies dropped once more into the wrong folder."""
    root, warehouse = drop_files(spark, sf_dir), work_path(spark, "warehouse")
    (crm_drops.raw_companies(spark, sf_dir).select(*csv_drop.EXPECTED_COLUMNS["companies"])
     .write.mode("append").option("header", True).option("escape", '"').csv(f"{root}/incoming/deals"))
    return root, ingest.load_drop(spark, root, warehouse, LOADED_AT, "run")


_MISMATCH = ("header mismatch for deals: got [" + ", ".join(csv_drop.EXPECTED_COLUMNS["companies"])
             + "], expected [" + ", ".join(csv_drop.EXPECTED_COLUMNS["deals"]) + "]")


@query("header_gate", sql.with_ctes(sql.RAW_DEALS, sql.RAW_COMPANIES, body=f"""
SELECT 'deals' AS target_table, 'loaded' AS status, NULL AS message, count(*) AS n_rows FROM raw_deals
UNION ALL SELECT 'companies', 'loaded', NULL, count(*) FROM raw_companies
UNION ALL SELECT 'deals', 'rejected', '{_MISMATCH}', NULL"""))
def _(spark, sf_dir):
    # How many files hold the rows depends on the cluster, so rows are compared.
    _, outcomes = _mixed_outcomes(spark, sf_dir)
    return outcomes.groupBy("target_table", "status", "message").agg(F.sum("row_count").alias("n_rows"))


@query("file_outcomes", sql.with_ctes(sql.RAW_DEALS, sql.RAW_COMPANIES, body=f"""
SELECT 'loaded' AS status, 'processed' AS folder, NULL AS message,
       (SELECT count(*) FROM raw_deals) + (SELECT count(*) FROM raw_companies) AS n_rows
UNION ALL SELECT 'rejected', 'rejected', '{_MISMATCH}', NULL"""))
def _(spark, sf_dir):
    root, outcomes = _mixed_outcomes(spark, sf_dir)
    names = ingest.file_outcomes(outcomes)
    return names.groupBy("status", F.regexp_extract("moves_to", "/(processed|rejected)/", 1).alias("folder"),
                         "message").agg(F.sum("row_count").alias("n_rows"))


def object_names(spark, sf_dir):
    """One object name per order, of every kind a bucket may hold."""
    k = F.col("order_id")
    day = F.to_date("created_at").cast("string")
    name = (F.when(k % 8 == 0, F.concat(F.lit("incoming/deals/deals_"), day, F.lit(".csv")))
            .when(k % 8 == 1, F.concat(F.lit("incoming/companies/companies_"), day, F.lit(".CSV")))
            .when(k % 8 == 2, F.concat(F.lit("processed/deals/deals_"), day, F.lit(".csv")))
            .when(k % 8 == 3, F.lit("incoming/deals/notes.txt"))
            .when(k % 8 == 4, F.concat(F.lit("incoming/invoices/"), day, F.lit(".csv")))
            .when(k % 8 == 5, F.concat(F.lit("incoming/deals/2026/"), day, F.lit(".csv")))
            .when(k % 8 == 6, F.concat(F.lit("incoming/deals/x_2001-99-99_"), day, F.lit(".csv")))
            .otherwise(F.lit("incoming/deals/no_date.csv")))
    return retail.orders(spark, sf_dir).select("order_id", name.alias("object_name"), "created_at")


NAMES = """
names AS (
  SELECT order_id, created_at, CASE order_id % 8
    WHEN 0 THEN 'incoming/deals/deals_' || CAST(created_at AS DATE) || '.csv'
    WHEN 1 THEN 'incoming/companies/companies_' || CAST(created_at AS DATE) || '.CSV'
    WHEN 2 THEN 'processed/deals/deals_' || CAST(created_at AS DATE) || '.csv'
    WHEN 3 THEN 'incoming/deals/notes.txt'
    WHEN 4 THEN 'incoming/invoices/' || CAST(created_at AS DATE) || '.csv'
    WHEN 5 THEN 'incoming/deals/2026/' || CAST(created_at AS DATE) || '.csv'
    WHEN 6 THEN 'incoming/deals/x_2001-99-99_' || CAST(created_at AS DATE) || '.csv'
    ELSE 'incoming/deals/no_date.csv' END AS object_name FROM r_orders
)"""
ROUTE = r"nullif(regexp_extract(object_name, '^incoming/(companies|deals)/[^/]*\.[cC][sS][vV]$', 1), '')"


@query("file_routing", sql.with_ctes(sql.ORDERS, NAMES, body=f"""
SELECT order_id, object_name, {ROUTE} AS target_table FROM names"""))
def _(spark, sf_dir):
    names = object_names(spark, sf_dir)
    return names.select("order_id", "object_name", csv_drop.route(F.col("object_name")).alias("target_table"))


@query("load_metadata", sql.with_ctes(sql.ORDERS, NAMES, body=r"""
SELECT order_id, 'drop/' || object_name AS _source_file,
       CAST(try_strptime(nullif(regexp_extract(object_name, '\d{4}-\d{2}-\d{2}'), ''), '%Y-%m-%d') AS DATE) AS _file_date,
       TIMESTAMP '2001-08-01 06:00:00' AS _loaded_at, DATE '2001-08-01' AS _load_date FROM names"""))
def _(spark, sf_dir):
    names = object_names(spark, sf_dir)
    return ingest.with_load_metadata(names, F.col("object_name"), F.concat(F.lit("drop/"), "object_name"),
                                     LOADED_AT).drop("object_name", "created_at")


@query("load_log_skip", sql.with_ctes(sql.ORDERS, NAMES, body="""
SELECT path, generation FROM (SELECT object_name || '#' || order_id AS path, CAST(order_id % 5 AS VARCHAR) AS generation, order_id FROM names)
WHERE NOT (order_id % 3 = 0 AND order_id % 5 <> 4)"""))
def _(spark, sf_dir):
    k = F.col("order_id")
    files = object_names(spark, sf_dir).select(
        F.concat("object_name", F.lit("#"), k.cast("string")).alias("path"), k,
        (k % 5).cast("string").alias("generation"))
    # Loaded, loaded as an older generation, rejected, loaded twice, never seen.
    log = files.select(F.col("path").alias("source_file"),
                       F.when(k % 5 == 4, "older").otherwise(F.col("generation")).alias("generation"),
                       F.when(k % 3 == 0, "loaded").when(k % 3 == 1, "rejected").alias("status"), k)
    log = log.filter(F.col("status").isNotNull())
    return ingest.not_yet_loaded(files, log.unionByName(log)).select("path", "generation")
