"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import pathlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablework.llm.tables import BLOCK_BYTES
from tablework.session import pin_session

ROOT = str(pathlib.Path(__file__).resolve().parents[2])
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


#: Allocator settings with which freed arrays of 2 MB go back to the system and 4 MB of smaller ones are held at most.
LEAN = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(2 << 20),
        "MALLOC_TRIM_THRESHOLD_": str(4 << 20)}


def with_workers(spark: SparkSession, lean: bool = False) -> SparkSession:
    """Pin the session, bound what Python workers get at once, and let them import this package from anywhere.

    With ``lean``, workers keep little of what an operator has freed, for
    sessions in which one operator after another uses the same workers.
    """
    for name, value in {"PYTHONPATH": ROOT, **(LEAN if lean else {})}.items():
        spark.sparkContext.environment.setdefault(name, value)
    # Batches end after so many bytes, not only after 10,000 rows; a longer row is a batch of its own.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BLOCK_BYTES))
    return pin_session(spark)


def query(name: str, oracle: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under a key."""
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(with_workers(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build
    return add
