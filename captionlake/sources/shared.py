"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; a folder of its own, which is set there, where all runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="captionlake-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody has used; Hadoop deletes it when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
