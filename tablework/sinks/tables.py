"""Writing partitioned Parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Shuffle by the partition columns before a partitioned write.

    Rebalancing gives few files per partition value, and Spark splits a value
    that holds far more rows than the others.
    """
    return df.hint("rebalance", *columns)


def append_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    spread_by(df, *columns).write.mode("append").partitionBy(*columns).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace exactly the partitions that ``df`` has rows for."""
    (spread_by(df, *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def replace_partition(df: DataFrame, path: str, column: str, value: dt.date) -> None:
    """Replace one partition, also when ``df`` is empty.

    A dynamic overwrite leaves a partition alone when there are no rows for
    it, so the one folder is named instead.
    """
    rows = df.filter(F.col(column) == F.lit(value)).drop(column)
    rows.write.mode("overwrite").parquet(f"{path}/{column}={value.isoformat()}")
