"""The folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names for checkpoints.

    Without that setting it lies below the session's warehouse, which every
    executor reaches too; no path of one machine is ever named here.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
