"""Where a job puts what its later passes read, and how Python workers find this package."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names, which driver and executors share. Without the setting a
    temporary folder takes its place, but only where everything runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_folder()


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package where the driver has it. On a cluster it is
    installed, or shipped with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes with the application."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame as read again from a table it was written to, so that several passes compute it once."""
    path = f"{own_folder(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
