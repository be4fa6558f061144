"""Intermediate tables in the folder that all executors and the driver share.

A job of several passes writes what the next pass reads. Such a table lies below `spark.checkpoint.dir`, so
a lost executor costs at most the tasks it was running.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.functions.folders import reach_workers, shared_folder

__all__ = ["WorkTables", "reach_workers", "shared_folder"]


class WorkTables:
    """Tables of one job. `keep` writes and rereads, `drop` deletes what no later pass reads.

    What is still there when the application ends goes with it.
    """

    def __init__(self, spark: SparkSession, job: str) -> None:
        reach_workers(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{job}-{uuid.uuid4().hex}"

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and return it as read from the written table."""
        path, store = self._path(name)
        df.write.mode("overwrite").parquet(str(path.toString()))
        store.deleteOnExit(path)
        schema = df.schema
        del df
        # Shuffle files of a finished pass go as soon as the driver collects its garbage.
        self.spark._jvm.System.gc()
        return self.spark.read.schema(schema).parquet(path.toString())

    def drop(self, *names: str) -> None:
        for name in names:
            path, store = self._path(name)
            store.delete(path, True)
