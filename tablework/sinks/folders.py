"""Tables whose current folders are named by a manifest.

Every write goes to a folder of its own, and then one rename puts a new manifest
in the place of the old one. A writer that stops before the rename has changed
nothing, so the same write can be repeated. Readers see the table before or
after a write, never between. The rule by which rows are dealt to parts stands
in the manifest, so all writers follow the one the table began with.

The file system must rename a file over another in one step, as HDFS and local
disks do. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tablework.sinks.tables import spread_by

MANIFEST = "manifest.json"


@dataclass(frozen=True)
class Manifest:
    rule: dict
    folders: dict[str, str] = field(default_factory=dict)  # part -> folder below the table


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    try:
        text = spark.read.text(f"{path}/{MANIFEST}", wholetext=True).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return Manifest(**json.loads(text))


def read_parts(spark: SparkSession, path: str, schema, manifest: Manifest | None, parts: Iterable[str] | None = None) -> DataFrame:
    """The rows of all parts, or of the named ones. A table or part that is not there has none."""
    listed = {} if manifest is None else manifest.folders
    wanted = sorted(listed) if parts is None else [p for p in sorted(set(parts)) if p in listed]
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{listed[p]}" for p in wanted])


def read_current(spark: SparkSession, path: str, schema) -> DataFrame:
    return read_parts(spark, path, schema, read_manifest(spark, path))


def replace_parts(rows: DataFrame, path: str, column: str, before: Manifest, gone: Iterable[str] = ()) -> None:
    """Make ``rows`` the content of their parts, the values of ``column``. Parts in ``gone`` end if they have no rows."""
    spark, folder = rows.sparkSession, f"data-{uuid.uuid4().hex}"
    spread_by(rows, column).write.partitionBy(column).parquet(f"{path}/{folder}")
    written = {name.partition("=")[2]: f"{folder}/{name}" for name in _children(spark, f"{path}/{folder}") if "=" in name}
    kept = {part: old for part, old in before.folders.items() if part not in set(gone)}
    draft = f"{path}/.{MANIFEST}-{uuid.uuid4().hex}"
    _write_text(spark, draft, json.dumps({"rule": before.rule, "folders": {**kept, **written}}, sort_keys=True))
    _rename_over(spark, draft, f"{path}/{MANIFEST}")


def drop_unlisted(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders of parts that were replaced or never listed. Call it when nobody reads or writes the table."""
    manifest = read_manifest(spark, path)
    listed = set() if manifest is None else set(manifest.folders.values())
    found = [f"{folder}/{part}" for folder in _children(spark, path) if folder.startswith("data-")
             for part in _children(spark, f"{path}/{folder}") if "=" in part]
    unlisted = sorted(set(found) - listed)
    for name in unlisted:
        files, at = _files(spark, f"{path}/{name}")
        files.delete(at, True)
    return unlisted


# Hadoop's file system, which knows every store that Spark can write to

def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _children(spark: SparkSession, path: str) -> list[str]:
    files, at = _files(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(at)) if files.exists(at) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, at = _files(spark, path)
    out = files.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _rename_over(spark: SparkSession, source: str, target: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files, old = _files(spark, source)
    old, new = files.makeQualified(old), files.makeQualified(hadoop.Path(target))
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(old.toUri(), files.getConf()).rename(old, new, options)
