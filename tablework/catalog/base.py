"""Registry of runnable queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Show instants as UTC wall clocks, whatever zone the caller collects in."""
    return df.select(*[F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp"
                       else F.col(f"`{name}`") for name, kind in df.dtypes])


def query(name: str, oracle: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under a key."""
    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(build(pin_session(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build
    return add
