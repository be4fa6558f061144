"""Writing metrics.

Streaming calls a batch function at least once. Each call writes a new attempt at its batch, out of the
readers' sight, and publishes it when all tables are there; see :mod:`tallyhouse.sources.metric_store`.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.schema import BATCH_COLUMN
from tallyhouse.sources.metric_store import (
    FORMAT,
    attempt_path,
    expire_batches,
    next_attempt,
    publish,
)

STORED_AT = "stored_at"
ROW_UUID = "batch_id"
# Batches of a replaced metric that stay, so that a reader that started before is not disturbed.
KEPT_BATCHES = 2


def audited(df: DataFrame, now: datetime, row_uuid: bool = False) -> DataFrame:
    """The rows with the moment of storing, one for the whole batch, and with a random id each."""
    if row_uuid:
        df = df.withColumn(ROW_UUID, F.expr("uuid()"))
    return df.withColumn(STORED_AT, F.lit(now))


@contextmanager
def batch_attempt(spark: SparkSession, root: str, batch_id: int) -> Iterator[int]:
    """The number of a new attempt at a batch, which is published unless an error ends the block."""
    attempt = next_attempt(spark, root, batch_id)
    yield attempt
    publish(spark, root, batch_id, attempt)


def write_rows(
    df: DataFrame, root: str, name: str, batch_id: int, attempt: int, fmt: str = FORMAT
) -> None:
    """Write a batch's rows of a metric, with the batch's id."""
    rows = df.withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
    rows.write.format(fmt).mode("overwrite").save(attempt_path(root, name, batch_id, attempt))


def store_metric(
    df: DataFrame, root: str, name: str, batch_id: int, keep: int | None = None, fmt: str = FORMAT
) -> None:
    """Store and publish a batch that has this one table. With ``keep`` older batches of it go."""
    spark = df.sparkSession
    with batch_attempt(spark, root, batch_id) as attempt:
        write_rows(df, root, name, batch_id, attempt, fmt)
    if keep is not None:
        expire_batches(spark, root, name, keep)
