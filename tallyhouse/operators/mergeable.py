"""Metrics over any number of batches, from a state of each that can be merged.

A distinct count or a ratio of one batch cannot be added to that of another. What can be merged is the set of
values behind it, next to sums, counts and maxima. The state of a metric is a frame of such rows, by the keys of
the metric, in one of two exact forms:

* *values*: one row per key and distinct value, for many keys with few values each (orders of a customer);
* *bitmaps*: one row per key and range of 32,768 numbers with the bits of those that occur, for few keys with many
  values each (orders of a location). Text is a number here only where the number prints as that text; any
  other value has a row of its own, so that the form is exact for all values.

States of batches are unioned and merged; the merged state is a combined frame (:mod:`combining`), so the
functions of the metrics run on it unchanged, and merging merged states gives the same again.

Where only an estimate is wanted, a *sketch* of fixed size per key takes the place of the set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import quoted
from tallyhouse.operators.catalogue import METRICS, Metric
from tallyhouse.operators.combining import EVENT_ROWS, combine, counter, distinct_counter

VALUES, BITMAPS = "values", "bitmaps"

_RANGE, _BITS, _OTHER = "value_range", "value_bits", "other_value"


@dataclass(frozen=True)
class State:
    """The stored state of a metric, and the metrics that are computed from it."""

    table: str
    metric: Metric
    form: str
    serves: tuple[str, ...]


def _state(table: str, form: str, *serves: str) -> State:
    first = METRICS[serves[0]]
    return State(table, first, form, serves)


STATES: dict[str, State] = {
    state.table: state
    for state in (
        _state("location_orders_state", BITMAPS, "avg_order_value"),
        _state("customer_orders_state", VALUES, "rfm"),
        _state("customer_sessions_state", VALUES, "app_usage", "avg_session_duration"),
        _state("product_moments_state", VALUES, "inventory_turnover"),
    )
}
STATE_OF = {name: state for state in STATES.values() for name in state.serves}


def state_metric(state: State, by: Sequence[str] = ()) -> Metric:
    """The metric whose combined frame the state starts from: a row per key and value."""
    metric = state.metric
    return replace(metric, keys=(*by, *metric.keys, *metric.distincts), distincts=())


def _measures(metric: Metric, frame: DataFrame) -> list[Column]:
    sums = [F.sum(quoted(name)).alias(name) for name in metric.sums]
    maxes = [F.max(quoted(name)).alias(name) for name in metric.maxes]
    counts = [F.sum(name).alias(name) for name in (*map(counter, metric.counts), EVENT_ROWS)]
    return sums + maxes + counts


def _values(events: DataFrame, metric: Metric, by: Sequence[str]) -> DataFrame:
    keys = [*by, *metric.keys, *metric.distincts]
    return combine(events, keys, sums=metric.sums, counts=metric.counts, maxes=metric.maxes)


def state_of(events: DataFrame, state: State, by: Sequence[str] = ()) -> DataFrame:
    """The state of a batch of events, or, with ``by``, of several batches at once."""
    metric = state.metric
    rows = _values(events, metric, by)
    if state.form == VALUES:
        return rows
    (name,) = metric.distincts
    text = quoted(name).cast("string")
    number = text.try_cast("bigint")
    numbered = F.coalesce((number >= 0) & (number.cast("string") == text), F.lit(False))
    split = rows.withColumns(
        {
            _RANGE: F.when(numbered, F.bitmap_bucket_number(number)),
            _OTHER: F.when(~numbered, text),
            _BITS: F.when(numbered, F.bitmap_bit_position(number)),
        }
    )
    return split.groupBy(*by, *metric.keys, _RANGE, _OTHER).agg(
        F.bitmap_construct_agg(_BITS).alias(_BITS), *_measures(metric, split)
    )


def merged(states: DataFrame, state: State, by: Sequence[str] = ()) -> DataFrame:
    """States of several batches as one, a combined frame on which the metrics run."""
    metric = state.metric
    if state.form == VALUES:
        return combine(
            states,
            [*by, *metric.keys, *metric.distincts],
            sums=metric.sums,
            counts=metric.counts,
            maxes=metric.maxes,
            distincts=metric.distincts,
        )
    (name,) = metric.distincts
    one = states.groupBy(*by, *metric.keys, _RANGE, _OTHER).agg(
        F.bitmap_or_agg(_BITS).alias(_BITS), *_measures(metric, states)
    )
    in_range = F.bitmap_count(_BITS)
    held = F.when(F.col(_RANGE).isNotNull(), in_range).otherwise(F.col(_OTHER).isNotNull().cast("bigint"))
    return one.withColumn(distinct_counter(name), held)


def over_batches(states: DataFrame, name: str, **options) -> DataFrame:
    """A metric over all batches whose states are given."""
    state = STATE_OF[name]
    return METRICS[name].compute(merged(states, state), **options)


def traffic_sketch(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A sketch of the customers, of a size that does not grow with their number."""
    return events.groupBy(*by).agg(F.hll_sketch_agg("customer_id").alias("customers"))


def traffic_over_batches(sketches: DataFrame) -> DataFrame:
    """Approximate number of distinct customers over all batches."""
    union = F.hll_sketch_estimate(F.hll_union_agg("customers"))
    return sketches.agg(F.coalesce(union, F.lit(0)).cast("bigint").alias("website_traffic"))
