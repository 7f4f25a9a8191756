"""What queries need of a session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset a local master, whose executors are the driver's own, gets a temporary folder;
    on a cluster that is an error, as executors would not see each other's files.
    """
    context = spark.sparkContext
    if found := context.getConf().get("spark.checkpoint.dir"):
        return found.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = context._jsc.sc().getCheckpointDir()
    return at.get() if at.isDefined() else tempfile.mkdtemp(prefix="shared-")


def shared_folder(spark: SparkSession) -> None:
    """Makes checkpoint() usable, in shared_dir()."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
