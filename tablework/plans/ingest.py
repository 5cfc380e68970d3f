"""Load dropped CSV files into append-only raw tables, each file once."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.clock import instant
from tablework.plans.replicate import read_table
from tablework.session import work_path
from tablework.sinks.tables import spread_by
from tablework.sources import csv_drop

LOAD_LOG_SCHEMA = ("source_file string, generation string, target_table string, row_count bigint, status string, "
                   "message string, loaded_at timestamp, _batch_id string")
FILES_PER_BATCH = 1000


def read_load_log(spark: SparkSession, warehouse: str) -> DataFrame:
    log = read_table(spark, f"{warehouse}/load_log", LOAD_LOG_SCHEMA)
    return spark.createDataFrame([], LOAD_LOG_SCHEMA) if log is None else log


def not_yet_loaded(files: DataFrame, load_log: DataFrame) -> DataFrame:
    """Files without a ``loaded`` entry for their generation. Rejected files may be tried again."""
    loaded = (load_log.filter(F.col("status") == "loaded")
              .select(F.col("source_file").alias("path"), "generation").distinct())
    return files.join(loaded, ["path", "generation"], "left_anti")


def raw_schema(table: str) -> str:
    texts = ", ".join(f"{c} string" for c in csv_drop.EXPECTED_COLUMNS[table])
    return f"{texts}, _source_file string, _file_date date, _loaded_at timestamp, _batch_id string, _load_date date"


def read_raw(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The raw table. Rows count once their batch is in the load log.

    A load that stopped before its log entry left rows that nobody sees.
    """
    raw = read_table(spark, f"{warehouse}/raw/{table}", raw_schema(table))
    if raw is None:
        return spark.createDataFrame([], raw_schema(table))
    done = (read_load_log(spark, warehouse).filter((F.col("status") == "loaded") & (F.col("target_table") == table))
            .select("_batch_id").distinct())
    return raw.join(done, "_batch_id", "left_semi")


def with_load_metadata(rows: DataFrame, object_name, source, loaded_at: dt.datetime) -> DataFrame:
    return rows.withColumns({"_source_file": source, "_file_date": csv_drop.file_date(object_name),
                             "_loaded_at": instant(loaded_at), "_load_date": F.to_date(instant(loaded_at))})


def fresh_id(name: str) -> str:
    """An id that no earlier attempt used, so nothing the load log lists is ever written again."""
    return f"{name}-{uuid.uuid4().hex}"


def load_files(spark: SparkSession, files: DataFrame, warehouse: str, batch_id: str,
               loaded_at: dt.datetime) -> list[str]:
    """Load one batch of files and log an outcome for each; returns their paths.

    ``files`` is bounded by the caller and comes from ``file_columns``. Records are parsed once, into a staged
    table; verdicts and rows both come from it, so they agree even if a file
    changes meanwhile. Rows are written before the log, into a folder that must
    not exist yet: see ``fresh_id``.
    """
    chosen = not_yet_loaded(files.filter(F.col("target_table").isNotNull()), read_load_log(spark, warehouse))
    entries = chosen.select("path", "object_name", "generation", "target_table").collect()
    outcomes = None
    for table, columns in csv_drop.EXPECTED_COLUMNS.items():
        named = [e for e in entries if e["target_table"] == table]
        if not named:
            continue
        staged = work_path(spark, f"parsed-{table}")
        csv_drop.parse_files(spark, [e["path"] for e in named], columns).write.parquet(staged)
        texts = ", ".join(f"`{c}` string" for c in columns)
        rows = spark.read.schema(f"{texts}, _malformed string, path string, _line bigint").parquet(staged)
        # One row per file of the batch, used twice: kept rather than computed again.
        found = {v["path"]: (v["_header_line"], v["status"], v["row_count"], v["message"])
                 for v in csv_drop.file_verdicts(rows, table).collect()}
        empty = (None, "rejected", None, csv_drop.no_header(table))
        verdicts = spark.createDataFrame(
            [(*e, *found.get(e["path"], empty)) for e in named],
            "path string, object_name string, generation string, target_table string, _header_line bigint, "
            "status string, row_count bigint, message string")
        good = verdicts.filter(F.col("status") == "loaded").select("path", "object_name", "_header_line")
        data = rows.join(F.broadcast(good), "path").filter(~F.col("_line").eqNullSafe(F.col("_header_line")))
        loaded = with_load_metadata(data, F.col("object_name"), F.col("path"), loaded_at).select(
            *columns, "_source_file", "_file_date", "_loaded_at", "_load_date")
        (spread_by(loaded, "_load_date").write.partitionBy("_load_date")
         .parquet(f"{warehouse}/raw/{table}/_batch_id={batch_id}"))
        part = verdicts.select(F.col("path").alias("source_file"), "generation", "target_table", "row_count",
                               "status", "message", instant(loaded_at).alias("loaded_at"),
                               F.lit(batch_id).alias("_batch_id"))
        outcomes = part if outcomes is None else outcomes.unionByName(part)
    if outcomes is not None:
        outcomes.write.mode("append").parquet(f"{warehouse}/load_log")
    return [e["path"] for e in entries]


def load_drop(spark: SparkSession, root: str, warehouse: str, loaded_at: dt.datetime, run_id: str,
              files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Load every new file under ``root``, in batches by path; also files written again.

    Returns the outcomes of this run, one row per file.
    """
    last, step = "", 0
    attempt = fresh_id(run_id)
    while True:
        files = csv_drop.list_files(spark, root)
        pending = not_yet_loaded(files.filter(F.col("target_table").isNotNull()), read_load_log(spark, warehouse))
        batch = pending.filter(F.col("path") > last).orderBy("path").limit(files_per_batch)
        handled = load_files(spark, batch, warehouse, f"{attempt}-{step}", loaded_at)
        if len(handled) < files_per_batch:
            return read_load_log(spark, warehouse).filter(F.col("_batch_id").startswith(f"{attempt}-"))
        last, step = max(handled), step + 1


def file_outcomes(load_log: DataFrame) -> DataFrame:
    """Where each handled file belongs: processed or rejected, with the reason."""
    folder = F.when(F.col("status") == "loaded", "processed/").otherwise("rejected/")
    # Of the object name only; a folder above may have the same name.
    return load_log.select("source_file", "status", "row_count", "message", F.regexp_replace(
        F.col("source_file"), F.lit(f"{csv_drop.INCOMING}(?=[^/]+/[^/]+$)"), folder).alias("moves_to"))
