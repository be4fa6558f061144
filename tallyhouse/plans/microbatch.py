"""All metrics of one micro-batch.

Computed one by one, 18 metrics read and shuffle the batch 18 times. Here the metrics of one entity
share a base: the events combined by that entity once, from which the metrics are small roll-ups.
A base is a combined frame, so the metric functions run on it unchanged.

The bases are chosen so that none shuffles more than its metrics must: a customer's orders and
sessions are two bases, because one base for both would expand each event into three rows, and the
sums by product do not pass through the base by product and moment, which can be nearly as long as
the batch itself.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from tallyhouse.operators.catalogue import METRICS, Metric
from tallyhouse.operators.combining import combine
from tallyhouse.operators.customer import with_age_group


@dataclass(frozen=True)
class Base:
    """Events combined by keys for some metrics."""

    keys: tuple[str, ...]
    metrics: tuple[str, ...]


BASES = (
    Base(
        ("gender", "age_group", "payment_method", "transaction_status"),
        (
            "kpi_summary",
            "transaction_status_share",
            "gender_counts",
            "age_groups",
            "payment_method_counts",
        ),
    ),
    Base(
        ("product_name",), ("stock_sold", "top_selling_products", "product_profitability")
    ),
    Base(
        ("product_name", "transaction_date_readable"),
        ("product_performance", "inventory_turnover"),
    ),
    Base(("customer_id",), ("customer_lifetime_value", "rfm")),
    Base(("customer_id",), ("app_usage", "avg_session_duration")),
    Base(("location_store",), ("location_performance", "avg_order_value")),
)


@dataclass(frozen=True)
class MetricGroup:
    """Metrics that read one frame. A ``shared`` frame is read several times, so worth keeping."""

    frame: DataFrame
    metrics: tuple[Metric, ...]
    shared: bool


def _union_of(metrics: Iterable[Metric], use: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(name for metric in metrics for name in getattr(metric, use)))


def _combined(events: DataFrame, base: Base, metrics: tuple[Metric, ...]) -> DataFrame:
    source = with_age_group(events) if "age_group" in base.keys else events
    return combine(
        source,
        base.keys,
        sums=_union_of(metrics, "sums"),
        counts=_union_of(metrics, "counts"),
        maxes=_union_of(metrics, "maxes"),
        distincts=_union_of(metrics, "distincts"),
    )


def metric_groups(
    events: DataFrame, metrics: Iterable[Metric] = tuple(METRICS.values()), fused: bool = True
) -> list[MetricGroup]:
    """The metrics of a batch, grouped by the base they share; without fusing, each on its own."""
    chosen = {metric.name: metric for metric in metrics}
    groups: list[MetricGroup] = []
    for base in BASES if fused else ():
        members = tuple(chosen[name] for name in base.metrics if name in chosen)
        if len(members) > 1:
            groups.append(MetricGroup(_combined(events, base, members), members, shared=True))
            for metric in members:
                del chosen[metric.name]
    alone = [MetricGroup(events, (metric,), shared=False) for metric in chosen.values()]
    return groups + alone


def compute_metric(metric: Metric, frame: DataFrame, as_of: int | datetime) -> DataFrame:
    """The metric over events or over its base; ``as_of`` is the moment recency is counted to."""
    if metric.name == "rfm":
        return metric.compute(frame, as_of=as_of)
    return metric.compute(frame)
