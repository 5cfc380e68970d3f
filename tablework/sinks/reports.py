"""Publish report tables behind the data-quality gate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablework.functions.clock import instant, utc_stamp
from tablework.operators.quality import failing_checks, require_publishable
from tablework.plans.crm import REPORT_ORDER, ordered_report


def report_cells(df: DataFrame) -> DataFrame:
    """Values a spreadsheet takes: decimals as doubles, dates as ISO text, missing text as ''.

    A missing number stays NULL, because a column has one type; it is written
    as an empty CSV cell.
    """
    cells = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = F.coalesce(c.cast("string"), F.lit(""))
        elif isinstance(field.dataType, T.TimestampType):
            c = F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit(""))
        elif isinstance(field.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        cells.append(c.alias(field.name))
    return df.select(*cells)


def status_rows(quality: DataFrame, raw: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Refresh time, newest source file by name, and one line per failing check."""
    spark = raw.sparkSession
    refreshed = spark.range(1).select(F.lit("Last refreshed").alias("item"),
                                      utc_stamp(instant(as_of)).alias("value"))
    newest = raw.agg(F.coalesce(F.max("_source_file"), F.lit("")).alias("value")).select(
        F.lit("Source file").alias("item"), "value")
    warnings = failing_checks(quality).select(F.concat(F.lit("Warning: "), "check_name").alias("item"),
                                              F.col("failing_rows").cast("string").alias("value"))
    return refreshed.unionByName(newest).unionByName(warnings)


def publish(reports: Mapping[str, DataFrame], quality: DataFrame, raw: DataFrame, target: str,
            as_of: dt.datetime, dry_run: bool = False) -> DataFrame:
    """Check the gate, then rewrite every report and the status table.

    A dry run skips the gate and the writes and only counts. Returns one row
    per report with its row count.
    """
    if not dry_run:
        require_publishable(quality)
        for name, report in reports.items():
            shown = ordered_report(name, report) if name in REPORT_ORDER else report
            report_cells(shown).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(
                f"{target}/{name}")
        status_rows(quality, raw, as_of).write.mode("overwrite").option("header", True).csv(f"{target}/status")
    counts = None
    for name, report in reports.items():
        if not dry_run:
            report = raw.sparkSession.read.schema(report_cells(report).schema).option("header", True).csv(
                f"{target}/{name}")
        row = report.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("report"), "n_rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts
