"""Session settings the package counts on, and its shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="docketry-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    A local session that names no such folder, as in tests, gets one of its own; on a
    cluster, where executors would each write to their own disk, its lack is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
