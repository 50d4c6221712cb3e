"""Shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: the one the cluster names, else (single machine only) a new one."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="freightloom-")


def new_workspace(spark: SparkSession) -> str:
    """Base path for one run's tables, never used before."""
    return f"{shared_folder(spark)}/freightloom-{uuid.uuid4().hex}"
