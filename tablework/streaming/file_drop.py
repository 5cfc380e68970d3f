"""Load dropped files as they arrive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tablework.plans.ingest import FILES_PER_BATCH, fresh_id, load_files
from tablework.sources.csv_drop import FILE_SCHEMA, file_columns


def start_file_drop(spark: SparkSession, root: str, warehouse: str, checkpoint: str,
                    clock: Callable[[], dt.datetime], available_now: bool = True,
                    files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Stream of new files under ``root``; each micro-batch loads its files.

    The stream tracks which files it has handed out; the load log makes a
    repeated micro-batch harmless. A file that is written again under its old
    name is not new to the stream: load it with ``load_drop``.
    """
    files = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", files_per_batch).load(root)
             .select("path", "modificationTime", "length"))

    def load(batch: DataFrame, batch_id: int) -> None:
        load_files(batch.sparkSession, file_columns(batch, root), warehouse, fresh_id(f"stream-{batch_id}"), clock())

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
