"""Keyed merges as pure functions of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``updates`` replace target rows with the same key; others are added.

    ``updates`` holds one row per key. Merging the same updates twice gives the
    same table as merging them once.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


def keys_gone_from_source(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys to delete: in the target, no longer in the source."""
    return target.select(*keys).join(source.select(*keys), list(keys), "left_anti")
