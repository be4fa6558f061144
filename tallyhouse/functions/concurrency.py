"""Several Spark jobs at once from one driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

# Jobs submitted at the same time; most of those run here are too small to fill a cluster.
WIDTH = 8


def run_together(
    spark: SparkSession, tasks: Iterable[Callable[[], None]], width: int = WIDTH
) -> None:
    """Run the tasks side by side and raise the first error, if any.

    The threads take over the caller's local properties, so that stopping a streaming query also
    stops the jobs that its batch function runs here.
    """
    with ThreadPoolExecutor(width) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        for each in started:
            each.result()
