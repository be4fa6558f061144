"""Metrics by customer and by group of customers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import age_group, number, ratio
from tallyhouse.operators.combining import count_of, distinct_of

_DAY = 60 * 60 * 24


def customer_lifetime_value(events: DataFrame) -> DataFrame:
    """Sales per customer."""
    return events.groupBy("customer_id").agg(
        F.sum("total_sales_amount").alias("customer_lifetime_value")
    )


def _customer_count(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return events.groupBy(*keys).agg(count_of(events, "customer_id").alias("customer_count"))


def gender_counts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events with a customer, per gender (events, not people)."""
    return _customer_count(events, [*by, "gender"])


def with_age_group(events: DataFrame) -> DataFrame:
    """Events with their age band; a combined frame may hold it already."""
    if "age_group" in events.columns:
        return events
    return events.withColumn("age_group", age_group(F.col("age")))


def age_groups(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events with a customer, per age band."""
    return _customer_count(with_age_group(events), [*by, "age_group"])


def payment_method_counts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events with a customer, per payment method."""
    return _customer_count(events, [*by, "payment_method"])


def _epoch(as_of: int | datetime | Column | None) -> Column:
    if as_of is None:
        return F.unix_timestamp(F.current_timestamp())
    if isinstance(as_of, datetime):
        return F.unix_timestamp(F.lit(as_of))
    return F.lit(as_of)


def rfm(events: DataFrame, as_of: int | datetime | Column | None = None) -> DataFrame:
    """Frequency (distinct orders), monetary (sales) and recency per customer.

    Recency is the time from the last purchase to ``as_of`` (epoch seconds or a moment, by default
    now) in days, with fractions.
    """
    return (
        events.groupBy("customer_id")
        .agg(
            F.max("transaction_date").alias("last_purchase"),
            distinct_of(events, "order_id").alias("frequency"),
            F.sum("total_sales_amount").alias("monetary"),
        )
        .withColumn("recency", ratio(_epoch(as_of) - F.col("last_purchase"), F.lit(_DAY)))
        .drop("last_purchase")
    )


def app_usage(events: DataFrame) -> DataFrame:
    """Distinct sessions, session seconds and accessed features per customer.

    The duration counts once per event, so a session with three events counts three times.
    """
    return events.groupBy("customer_id").agg(
        distinct_of(events, "session_id").alias("total_sessions"),
        F.sum(number(events, "session_duration")).cast("double").alias("total_session_duration"),
        count_of(events, "feature_accessed").alias("total_features_accessed"),
    )


def avg_session_duration(events: DataFrame) -> DataFrame:
    """Session seconds per distinct session of each customer."""
    return app_usage(events).select(
        "customer_id",
        ratio(F.col("total_session_duration"), F.col("total_sessions")).alias(
            "avg_session_duration"
        ),
    )
