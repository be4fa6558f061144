"""Metrics by location and by sales representative."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import ratio
from tallyhouse.operators.combining import distinct_of


def _sales_and_quantity(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.sum("total_sales_amount").alias("total_sales_amount"),
        F.sum("quantity_sold").cast("bigint").alias("total_quantity_sold"),
    )


def sales_rep_performance(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales and quantity per sales representative."""
    return _sales_and_quantity(events, [*by, "sales_representative"])


def location_performance(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales and quantity per location."""
    return _sales_and_quantity(events, [*by, "location_store"])


def avg_order_value(events: DataFrame) -> DataFrame:
    """Sales per distinct order of each location; null where no event names an order."""
    return events.groupBy("location_store").agg(
        ratio(F.sum("total_sales_amount"), distinct_of(events, "order_id")).alias(
            "average_order_value"
        )
    )
