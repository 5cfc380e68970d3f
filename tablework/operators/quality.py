"""Data-quality checks, the gate they feed, and hard assertions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.clock import instant

FRESHNESS_HOURS = 36


class PublishBlocked(Exception):
    """A blocking check failed; nothing may be published."""


def count_checks(df: DataFrame, checks: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """One row per check, all counted in a single pass over ``df``."""
    counts = df.agg(*[F.count_if(failing).alias(name) for name, (_, failing) in checks.items()])
    rows = [F.struct(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
                     F.col(name).alias("failing_rows")) for name, (severity, _) in checks.items()]
    return counts.select(F.inline(F.array(*rows)))


def stale_data(raw: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Newest load older than 36 hours. No rows at all is not stale."""
    limit = as_of - dt.timedelta(hours=FRESHNESS_HOURS)
    stale = F.when(F.max("_loaded_at") < instant(limit), 1).otherwise(0)
    return raw.agg(stale.cast("bigint").alias("failing_rows")).select(
        F.lit("stale_data").alias("check_name"), F.lit("block").alias("severity"), "failing_rows")


def no_data(raw: DataFrame) -> DataFrame:
    """Opt-in companion of ``stale_data``: fails when there is no row at all."""
    return raw.agg(F.when(F.count("*") == 0, 1).otherwise(0).cast("bigint").alias("failing_rows")).select(
        F.lit("no_data").alias("check_name"), F.lit("block").alias("severity"), "failing_rows")


def data_quality(deals: DataFrame, raw_deals: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The four checks read before publishing: name, severity, failing rows."""
    counted = count_checks(deals, {
        "deals_without_company": ("block", F.col("company_name").isNull()),
        "unknown_stage": ("block", F.col("is_unknown_stage")),
        "missing_amount": ("warn", F.col("is_missing_amount")),
    })
    return counted.unionByName(stale_data(raw_deals, as_of))


def failing_checks(quality: DataFrame) -> DataFrame:
    return quality.filter(F.col("failing_rows") > 0).select(
        "check_name", "severity", "failing_rows", (F.col("severity") == "block").alias("blocks_publish"))


def require_publishable(quality: DataFrame) -> None:
    """Raise when a blocking check fails. The table holds one row per check."""
    blocking = failing_checks(quality).filter("blocks_publish").collect()
    if blocking:
        raise PublishBlocked("; ".join(f"{r.check_name}: {r.failing_rows} rows" for r in blocking))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond one per key.

    Grouping by the key first keeps a heavily repeated key to one partial row
    per task.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(key).alias("distinct_keys")).select(
        "rows", "distinct_keys", (F.col("rows") - F.col("distinct_keys")).alias("repeated"))


def assert_no_rows(df: DataFrame, count_column: str, message: str) -> DataFrame:
    """The same one-row result, failing loudly when the count is not zero."""
    return df.filter(F.assert_true(F.col(count_column) == 0, message).isNull())


def assert_blocking_checks(quality: DataFrame) -> DataFrame:
    failed = quality.agg(F.count_if((F.col("severity") == "block") & (F.col("failing_rows") > 0)).alias("failed"))
    return assert_no_rows(failed, "failed", "a blocking data quality check failed")


def assert_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    key = keys[0] if len(keys) == 1 else "_key"
    keyed = df if len(keys) == 1 else df.select(F.struct(*keys).alias("_key"))
    return assert_no_rows(repeated_keys(keyed, key), "repeated", f"{name} has repeated {', '.join(keys)}")
