"""The folder that the driver and all executors share, for what a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only where that is unset (a local session), one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lingolake-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
