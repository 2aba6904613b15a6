"""Folders for data that a job writes between its steps."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` session without the setting falls back to a temporary
    folder: on a cluster such a folder would exist on one machine alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="airstrata-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def workspace(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/airstrata/{label}-{uuid.uuid4().hex}"
