"""Scratch locations every executor can reach."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only where driver and executors are one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "riskweave")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark).rstrip('/')}/riskweave/{uuid.uuid4().hex}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that its owner no longer reads, through Spark's own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
