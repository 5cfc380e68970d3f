"""Many-to-one joins that stay even when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a table with one row per key.

    When ``right`` was just grouped or ranked by the same keys, Spark joins it
    without shuffling it again, and adaptive execution then cannot split a hot
    key of ``left``. Joining on a hash of the keys as well gives each side a
    shuffle of its own, which it can split. ``right`` is the smaller side.
    """
    hashed = F.xxhash64(*keys)
    joined = left.withColumn("_key_hash", hashed).join(
        right.withColumn("_key_hash", hashed), [*keys, "_key_hash"], "left")
    return joined.drop("_key_hash")
