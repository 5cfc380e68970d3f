"""Row keys, work sizes and intermediate tables shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.session import work_path

BLOCK_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write a table to the folder that all executors share, and read it back.

    Later steps then do not depend on shuffle files of lost executors, and
    every step sees the same rows.
    """
    spark = df.sparkSession
    path = work_path(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def key_columns(*columns: str) -> list[Column]:
    """Two 64-bit hashes that together name a document row.

    Rows that agree in all the columns are one document to the operators.
    """
    return [F.xxhash64(F.lit(salt), *[F.col(f"`{c}`") for c in columns]).alias(name)
            for salt, name in ((1, "key_a"), (2, "key_b"))]


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def parts(spark: SparkSession, size: int, each: int = BLOCK_BYTES) -> int:
    """How many parts of about ``each`` bytes; at least one for every shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))
