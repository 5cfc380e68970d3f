"""Dropped CSV files: which table they are for, and what is in them."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.text import PYTHON_BLANKS
from tablework.plans.crm import COMPANY_COLUMNS, DEAL_COLUMNS
from tablework.session import work_path

INCOMING = "incoming/"

# The columns of each table's file, in order.
EXPECTED_COLUMNS = {"companies": COMPANY_COLUMNS, "deals": DEAL_COLUMNS}

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
MAX_MESSAGE = 1000
_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def route(object_name: Column) -> Column:
    """Target table of ``incoming/<table>/<file>.csv``; anything else -> NULL.

    The folder is matched as written, the ending in any case.
    """
    parts = F.split(object_name, "/")
    table = F.try_element_at(parts, F.lit(2))
    fits = (object_name.startswith(INCOMING) & F.lower(object_name).endswith(".csv") & (F.size(parts) == 3)
            & table.isin(*EXPECTED_COLUMNS))
    return F.when(fits, table)


def file_date(object_name: Column) -> Column:
    """First ``dddd-dd-dd`` in the name, if it is a date."""
    return F.try_to_date(F.nullif(F.regexp_extract(object_name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")),
                         "yyyy-MM-dd")


def file_columns(files: DataFrame, root: str) -> DataFrame:
    """Identity of each file: its path, its name under ``root``, its generation.

    A file written again under the same name has another generation.
    """
    folder = posixpath.normpath("/" + re.sub(_STORE, "", root).lstrip("/")).rstrip("/") + "/"
    if not (re.match(_STORE, root) or root.startswith("/")):
        folder = posixpath.join(posixpath.abspath(root), "")
    place = F.regexp_replace("path", _STORE, "")
    named = files.withColumn("object_name", F.when(
        F.startswith(place, F.lit(folder)), F.substr(place, F.lit(len(folder) + 1))).otherwise(
        F.raise_error(F.concat(F.lit(f"not under {folder}: "), "path"))))
    return named.select(
        "path", "object_name",
        F.concat(F.unix_micros("modificationTime").cast("string"), F.lit("-"), F.col("length").cast("string"))
        .alias("generation"),
        route(F.col("object_name")).alias("target_table"), "length")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file under ``root``. Contents are not read. Spark skips files of no bytes."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(root).select("path", "modificationTime", "length"))
    return file_columns(found, root)


def file_path() -> Column:
    """The file of a row, spelled as a file listing spells it. A plus sign is no blank here."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def parse_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every record as text, the header record included; ``_line`` rises within a file.

    A quoted line break may go past any line, so a file of any size is read by
    one task, and all files by the same rules.
    """
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _malformed string"
    return (spark.read.schema(schema)
            .option("header", "false").option("multiLine", "true").option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_malformed")
            .csv(list(paths))
            .select(*columns, "_malformed", file_path().alias("path"),
                    F.monotonically_increasing_id().alias("_line")))


def header_cells(columns: Sequence[str]) -> Column:
    """The record's cells as a header: trimmed, lower case, no byte-order mark before the first."""
    cells = F.array(*[F.coalesce(F.col(c), F.lit("")) for c in columns])
    # A record with another number of cells is kept whole as text.
    whole = F.split(F.replace(F.col("_malformed"), F.lit('"'), F.lit("")), ",")
    cells = F.when(F.col("_malformed").isNotNull(), whole).otherwise(cells)
    return F.transform(cells, lambda c, i: F.lower(F.btrim(
        F.when(i == 0, F.ltrim(c, F.lit("\ufeff"))).otherwise(c), F.lit(PYTHON_BLANKS))))


def _mismatch(table: str) -> tuple[str, str]:
    return f"header mismatch for {table}: got [", f"], expected [{', '.join(EXPECTED_COLUMNS[table])}]"


def no_header(table: str) -> str:
    """The reason for a file without a single record."""
    return "".join(_mismatch(table))


def file_verdicts(rows: DataFrame, table: str) -> DataFrame:
    """One row per file: loaded with a row count, or rejected with the reason.

    A file is rejected for a header that differs in name or order, or for one
    malformed record.
    """
    expected = EXPECTED_COLUMNS[table]
    counted = rows.groupBy("path").agg(F.min("_line").alias("_header_line"), F.count("*").alias("records"),
                                       F.count("_malformed").alias("malformed"))
    # The header record of each file, found by its line. The counts are one
    # row per file of a bounded batch.
    first = counted.withColumnRenamed("_header_line", "_line")
    per_file = rows.join(F.broadcast(first), ["path", "_line"]).select(
        "path", F.col("_line").alias("_header_line"), "records", "malformed",
        header_cells(expected).alias("header"))
    want = F.array(*[F.lit(c) for c in expected])
    header_ok = F.col("header") == want
    got = F.array_join("header", ", ")
    problem = (F.when(~header_ok, F.concat(F.lit(_mismatch(table)[0]), got, F.lit(_mismatch(table)[1])))
               .when(F.col("malformed") > 0, F.concat(F.col("malformed").cast("string"),
                                                      F.lit(" malformed records"))))
    return per_file.select(
        "path", "_header_line", F.when(problem.isNull(), "loaded").otherwise("rejected").alias("status"),
        F.when(problem.isNull(), F.col("records") - 1).alias("row_count"),
        F.substring(problem, 1, MAX_MESSAGE).alias("message"))


def csv_drop(spark: SparkSession, paths: Sequence[str], table: str) -> DataFrame:
    """All rows of the files that pass the gate, as text, headers skipped."""
    columns = EXPECTED_COLUMNS[table]
    # Written once: Spark does not count malformed records of a file it is still parsing.
    staged, parsed = work_path(spark, f"parsed-{table}"), parse_files(spark, paths, columns)
    parsed.write.parquet(staged)
    rows = spark.read.schema(parsed.schema).parquet(staged)
    good = file_verdicts(rows, table).filter(F.col("status") == "loaded").select("path", "_header_line")
    # One row per file of a bounded batch: no task sorts all the rows of a file to join them.
    return rows.join(F.broadcast(good), "path").filter(F.col("_line") != F.col("_header_line")).select(
        *columns, F.col("path").alias("_source_file"))
