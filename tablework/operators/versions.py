"""Keep one version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The row with the greatest ``newest_first`` values for each key.

    Remaining columns break ties, so equal inputs always give the same row and
    exact duplicates collapse. Spark turns "rank = 1" into a group limit that
    runs before the shuffle, so a key that fills whole partitions sends one row
    per task.
    """
    tie_break = [c for c in df.columns if c not in {*keys, *newest_first}]
    order = [F.col(c).desc_nulls_last() for c in newest_first] + [F.col(c).asc_nulls_first() for c in tie_break]
    ranked = df.withColumn("_version_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_version_rank") == 1).drop("_version_rank")
