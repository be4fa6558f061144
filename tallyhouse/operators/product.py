"""Metrics by product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import ratio
from tallyhouse.operators.combining import distinct_of


def stock_sold(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quantity sold per product."""
    return events.groupBy(*by, "product_name").agg(
        F.sum("quantity_sold").cast("bigint").alias("stock_sold")
    )


def inventory_turnover(events: DataFrame) -> DataFrame:
    """Quantity sold per distinct moment (to the second) at which the product was sold."""
    return events.groupBy("product_name").agg(
        ratio(F.sum("quantity_sold"), distinct_of(events, "transaction_date_readable")).alias(
            "inventory_turnover"
        )
    )


def top_selling_products(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Quantity sold per product, for a ranking; order and limit are applied by the reader."""
    return events.groupBy(*by, "product_name").agg(
        F.sum("quantity_sold").cast("bigint").alias("total_quantity_sold")
    )


def product_performance(events: DataFrame) -> DataFrame:
    """Quantity and sales per product and moment of sale."""
    return events.groupBy("product_name", "transaction_date_readable").agg(
        F.sum("quantity_sold").cast("bigint").alias("quantity_sold"),
        F.sum("total_sales_amount").alias("total_sales_amount"),
    )


def product_profitability(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales, deductions and quantity per product; profit is sales minus all three deductions."""
    sales, discount = F.sum("total_sales_amount"), F.sum("discount_amount")
    tax, shipping = F.sum("tax_amount"), F.sum("shipping_fee")
    return events.groupBy(*by, "product_name").agg(
        sales.alias("total_sales_amount"),
        discount.alias("total_discount_amount"),
        tax.alias("total_tax_amount"),
        shipping.alias("total_shipping_fee"),
        F.sum("quantity_sold").cast("bigint").alias("total_quantity_sold"),
        (sales - discount - tax - shipping).alias("profit"),
    )
