"""Where intermediate tables go: the shared checkpoint folder of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names or the context has; on one machine alone a temporary one, if neither is set.

    On a cluster, executors don't see each other's own folders: without a shared one this is an error."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    held = context._jsc.sc().getCheckpointDir()
    if named or held.isDefined():
        return named or held.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="scratch")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}/{name}"
