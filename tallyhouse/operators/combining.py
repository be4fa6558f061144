"""Collapsing events before they are shuffled again.

A combined frame has one row per key, with its measures already summed under the names they have in
the events, and with counters next to them: ``<column>_rows`` counts the rows where the column was
not null, ``event_rows`` counts all rows, and ``<column>_distinct`` counts the distinct values of a
column within the key. The metrics count through :func:`count_of`, :func:`row_count` and
:func:`distinct_of`, so each of them gives the same result on events and on a combined frame; only
distinct counts ask for a frame combined by the very key of the metric.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import number

EVENT_ROWS = "event_rows"


def counter(column: str) -> str:
    return f"{column}_rows"


def distinct_counter(column: str) -> str:
    return f"{column}_distinct"


def count_of(events: DataFrame, column: str) -> Column:
    """Number of events whose column is not null."""
    if counter(column) in events.columns:
        return F.coalesce(F.sum(counter(column)), F.lit(0)).cast("bigint")
    return F.count(column)


def row_count(events: DataFrame) -> Column:
    """Number of events."""
    if EVENT_ROWS in events.columns:
        return F.coalesce(F.sum(EVENT_ROWS), F.lit(0)).cast("bigint")
    return F.count(F.lit(1))


def distinct_of(events: DataFrame, column: str) -> Column:
    """Number of distinct values, nulls apart."""
    if distinct_counter(column) in events.columns:
        return F.sum(distinct_counter(column)).cast("bigint")
    return F.count_distinct(column)


def combine(
    events: DataFrame,
    keys: Iterable[str],
    sums: Iterable[str] = (),
    counts: Iterable[str] = (),
    maxes: Iterable[str] = (),
    distincts: Sequence[str] = (),
) -> DataFrame:
    """One row per key. Spark combines inside each map task first, so a key that holds a large
    part of all events reaches the shuffle as one row per task.

    A column counted for its distinct values may be one of the keys: each row then holds one value,
    and the sum of these ones over the other keys is the distinct count of a coarser key.
    """
    keys = list(keys)
    within = [name for name in distincts if name not in keys]
    measures = [F.sum(number(events, name)).alias(name) for name in sums]
    measures += [F.max(name).alias(name) for name in maxes]
    measures += [count_of(events, name).alias(counter(name)) for name in counts]
    measures += [distinct_of(events, name).alias(distinct_counter(name)) for name in within]
    measures.append(row_count(events).alias(EVENT_ROWS))
    ones = {
        distinct_counter(name): F.col(name).isNotNull().cast("bigint")
        for name in distincts
        if name in keys
    }
    combined = events.groupBy(*keys).agg(*measures)
    return combined.withColumns(ones) if ones else combined
