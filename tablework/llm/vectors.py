"""Vector rows that take part in a search, and the meeting of all queries with all rows in bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.operators.joins import lookup

#: Bytes of double-precision vectors in one block of rows or of queries.
VECTOR_BLOCK_BYTES = 16 << 20
#: Up to so many blocks of queries where there are few blocks of rows, so that small tables use several tasks.
LEAST_MEETINGS = 8


def finite(vector: Column) -> Column:
    """Whether the vector is there and every component is a finite number."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def block_rows(dims: int) -> int:
    return max(256, VECTOR_BLOCK_BYTES // (8 * dims))


def dimensions(rows: DataFrame, vector: str = "vector") -> int:
    return rows.agg(F.max(F.size(vector))).first()[0] or 1


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The vectors as rows of doubles; a shorter vector is continued with zeros."""
    if column.num_chunks == 0:
        return np.zeros((0, dims))
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    sizes = np.diff(lists.offsets.to_numpy())
    if len(flat) == len(sizes) * dims:
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _counts(rows: Column, queries: Column, each: int) -> list[Column]:
    pieces = F.ceil(rows / each)
    few = F.least(F.ceil(F.lit(LEAST_MEETINGS) / pieces), F.ceil(queries / 16))
    return [pieces.alias("_pieces"), F.greatest(F.ceil(queries / each), few, F.lit(1)).alias("_batches")]


def meet(queries: DataFrame, rows: DataFrame, work: Callable, schema: str, dims: int, by: Sequence[str] = ()) -> DataFrame:
    """``work(key, queries, rows)`` on blocks, so that each query meets each row that has its values of ``by`` once.

    Rows are dealt into pieces and queries into batches of ``block_rows`` by a
    hash of their ``vec_id``; a block of either is repeated for each block of
    the other. So a task holds one block of each, however many rows share a
    value of ``by``. Tables are read more than once: hand in staged ones.
    """
    each, by = block_rows(dims), list(by)
    if by:
        sizes = rows.groupBy(*by).agg(F.count("*").alias("_rows")).join(
            queries.groupBy(*by).agg(F.count("*").alias("_queries")), by)
        sizes = sizes.select(*by, *_counts(F.col("_rows"), F.col("_queries"), each))
        queries, rows = (lookup(df, sizes, by).where("_pieces IS NOT NULL") for df in (queries, rows))
    else:
        n, q = rows.count(), queries.count()
        counts = _counts(F.lit(max(n, 1)), F.lit(q), each)
        queries, rows = queries.select("*", *counts), rows.select("*", *counts)
    dealt = {"_piece": F.pmod(F.xxhash64("vec_id"), F.col("_pieces")), "_batch": F.pmod(F.xxhash64("vec_id"), F.col("_batches"))}
    spread = {"_piece": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)),
              "_batch": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_batches") - 1))}
    queries = queries.withColumn("_batch", dealt["_batch"]).withColumn("_piece", spread["_piece"])
    rows = rows.withColumn("_piece", dealt["_piece"]).withColumn("_batch", spread["_batch"])
    keys = [*by, "_piece", "_batch"]
    left, right = (df.drop("_pieces", "_batches").groupBy(*keys) for df in (queries, rows))
    return left.cogroup(right).applyInArrow(work, schema)


def best(group: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Indices of each group's ``k`` entries of highest score, ties by smaller ``tie``; ordered by group and rank."""
    order = np.lexsort((tie, -score, group))
    sorted_group = group[order]
    new = np.concatenate([[True], sorted_group[1:] != sorted_group[:-1]]) if len(order) else np.zeros(0, bool)
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[rank < k]
