"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where it is unset and driver and executors are one process. On a cluster, unset is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        root = _own[0]
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
