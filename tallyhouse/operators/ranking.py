"""Order and limit, applied when a metric is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import quoted


def ranked(df: DataFrame, measure: str, *ties: str, limit: int | None = None) -> DataFrame:
    """Rows by falling measure, ties by rising ``ties``. With a limit each task keeps its own top
    rows and only those are brought together."""
    ordered = df.orderBy(quoted(measure).desc(), *[quoted(tie).asc() for tie in ties])
    return ordered if limit is None else ordered.limit(limit)


def first_rows(df: DataFrame, *keys: str, limit: int | None) -> DataFrame:
    """The first rows in the order of the keys, all of them without a limit."""
    ordered = df.orderBy(*[quoted(key).asc() for key in keys])
    return ordered if limit is None else ordered.limit(limit)


def sampled(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """``k`` rows drawn at random by a digest of seed and key.

    Unlike ``rand(seed)``, the draw does not depend on how the rows are partitioned, so a task that
    runs again after a lost executor draws the same rows.
    """
    lot = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    return df.orderBy(lot, F.col(key)).limit(k)
