"""Shared working folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Have the folder's file system delete it when this driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local session without that setting may use a folder of this machine.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING, None
    )
    if shared:
        folder = f"{shared.rstrip('/')}/plateflow/{name}-{uuid.uuid4().hex}"
        _delete_at_exit(spark, folder)
        return f"{folder}/data"
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix=f"plateflow-{name}-")
        _delete_at_exit(spark, f"file://{folder}")
        return f"{folder}/data"
    raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
