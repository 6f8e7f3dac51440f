"""Folders for data that a job writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the one the cluster names in ``spark.checkpoint.dir``, or
    the context's checkpoint folder.

    Without either a folder of this machine is used, in local mode only,
    where driver and executors are one process.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = context.applicationId
        if app not in _local_root:
            _local_root[app] = tempfile.mkdtemp(prefix="tapeflow-")
        root = _local_root[app]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written once and read back, for results that are used several times."""
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
