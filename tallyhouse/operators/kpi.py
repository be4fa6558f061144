"""Metrics over all events: key figures, traffic and the share of each transaction status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import ratio
from tallyhouse.operators.combining import count_of, row_count


def kpi_summary(events: DataFrame) -> DataFrame:
    """One row of key figures. ``avg_sales`` divides by the events with an order, not by distinct
    orders, and ``total_inventory_value`` is the quantity sold."""
    total = F.sum("total_sales_amount")
    return events.agg(
        total.alias("total_sales"),
        (total - F.sum("discount_amount")).alias("revenue"),
        ratio(total, count_of(events, "order_id")).alias("avg_sales"),
        F.sum("quantity_sold").cast("bigint").alias("total_inventory_value"),
    )


def website_traffic(events: DataFrame) -> DataFrame:
    """Approximate number of distinct customers, at the default relative deviation of 0.05."""
    return events.agg(F.approx_count_distinct("customer_id").alias("website_traffic"))


def website_traffic_exact(events: DataFrame) -> DataFrame:
    return events.agg(F.count_distinct("customer_id").alias("website_traffic"))


def transaction_status_share(events: DataFrame, population: DataFrame | None = None) -> DataFrame:
    """Orders per transaction status, and their share of all events in percent.

    The total is a scalar subquery. ``population`` may name a cheaper frame with the same number of
    events, for instance the same view without the columns that need joins.
    """
    everyone = events if population is None else population
    total = everyone.agg(row_count(everyone).alias("n")).scalar()
    per_status = events.groupBy("transaction_status").agg(
        count_of(events, "order_id").alias("orders_count")
    )
    return per_status.withColumn("bounce_rate", ratio(F.col("orders_count"), total) * 100)
