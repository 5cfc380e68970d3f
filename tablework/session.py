"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def pin_session(spark: SparkSession) -> SparkSession:
    """Settings of a running session: two for the results, one for skew."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    # Split a hot join key also where that costs one more shuffle. Without it,
    # two joins on one key in a row would leave the key in one task.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a session on a local master may go without the setting, as in tests;
    it gets one temporary folder for its lifetime.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _LOCAL_DIRS:
            _LOCAL_DIRS[context.applicationId] = "file:" + tempfile.mkdtemp(prefix="run-")
        configured = _LOCAL_DIRS[context.applicationId]
    return configured.rstrip("/")


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder for one written intermediate table."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
