"""A training corpus from ``documents``: five stages, each on what the one before kept.

Every stage but the last returns the columns of ``documents``. Between stages
the rows are written as Parquet to the folder that all executors share, so a
lost executor costs the work of one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.decontaminate import drop_contaminated
from tablework.llm.jaccard_join import keep_one_each
from tablework.llm.language_id import fit, held_out, keep_identified
from tablework.llm.line_dedup import remove_repeated_runs
from tablework.llm.query_subword_samples import MODEL
from tablework.llm.registry import with_workers
from tablework.llm.subword_samples import encode_samples
from tablework.llm.tables import read, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is not recognised go. The recogniser learns from the labelled three quarters of ``docs``."""
    with_workers(spark, lean=True)
    return keep_identified(docs, fit(docs.where(~held_out())))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of two or more lines that stand earlier go from the texts; documents that lose all their words to it go whole."""
    with_workers(spark, lean=True)
    out = remove_repeated_runs(docs)
    whole = (F.col("n_removed") == 0) | F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    changed = F.when(F.col("n_removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.where(whole).withColumn("n_chars", changed).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    with_workers(spark, lean=True)
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    with_workers(spark, lean=True)
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def subwords(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of what is left, as token ids."""
    with_workers(spark, lean=True)
    return encode_samples(docs, public_tokenizers.path(MODEL), remember=False)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", near_duplicates),
    ("decontaminate", decontamination),
    ("subword_samples", subwords),
]

#: SQL expresses neither the recogniser nor the sampling; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
