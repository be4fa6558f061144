"""Dashboard queries over stored metrics.

Each takes the rows of one metric: of all stored batches where the metric is appended, of the newest
batch where it is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalars import quoted
from tallyhouse.operators.ranking import first_rows, sampled

# Rows shown per chart, width of a histogram bucket, locations drawn at random.
SERIES_ROWS = 15
POINT_ROWS = 15
TURNOVER_ROWS = 12
BUCKET_WIDTH = 50
LOCATIONS_SHOWN = 5

# Wide enough for a sum of stored sums, exact to the digits that amounts have.
_EXACT = "decimal(38,6)"


def _total(rows: DataFrame, name: str) -> Column:
    """Sum over batches; amounts as decimals, so the total does not depend on the rows' order."""
    if isinstance(rows.schema[name].dataType, (T.DecimalType, T.FractionalType)):
        return F.sum(quoted(name).cast(_EXACT)).cast(_EXACT).alias(name)
    return F.sum(quoted(name)).cast("bigint").alias(name)


def cumulative(rows: DataFrame, keys: Iterable[str], sums: Iterable[str]) -> DataFrame:
    """A metric over all its batches. Right for sums and counts only: distinct counts and ratios of
    single batches do not add up."""
    return rows.groupBy(*keys).agg(*[_total(rows, name) for name in sums])


def gender_totals(gender_counts: DataFrame) -> DataFrame:
    """Customers counted as male and as female over all batches, in any spelling, in one row."""
    gender = F.lower("gender")

    def counted(value: str) -> Column:
        total = F.sum(F.when(gender == value, F.col("customer_count")))
        return F.coalesce(total, F.lit(0)).cast("bigint").alias(f"{value}_count")

    return gender_counts.agg(counted("male"), counted("female"))


def product_performance_series(
    product_performance: DataFrame, limit: int | None = SERIES_ROWS
) -> DataFrame:
    """The earliest moments of sale with quantity and sales."""
    first = first_rows(
        product_performance, "transaction_date_readable", "product_name", limit=limit
    )
    return first.select("transaction_date_readable", "quantity_sold", "total_sales_amount")


def profit_by_product(product_profitability: DataFrame) -> DataFrame:
    return cumulative(
        product_profitability, ["product_name"], ["total_sales_amount", "total_discount_amount"]
    )


def profitability_points(
    product_profitability: DataFrame, limit: int | None = POINT_ROWS
) -> DataFrame:
    """Sales and discount of the first products by name, over all batches."""
    first = first_rows(profit_by_product(product_profitability), "product_name", limit=limit)
    return first.select("total_sales_amount", "total_discount_amount")


def payment_method_table(payment_method_counts: DataFrame) -> DataFrame:
    """Events per payment method over all batches."""
    return cumulative(payment_method_counts, ["payment_method"], ["customer_count"])


def location_table(location_performance: DataFrame) -> DataFrame:
    return location_performance.select(
        "location_store", "total_sales_amount", "total_quantity_sold"
    )


def monetary_values(rfm: DataFrame) -> DataFrame:
    return rfm.select("monetary")


def latest_kpis(kpis: DataFrame) -> DataFrame:
    """The key figures of the newest batch; no row when there is none."""
    return kpis.select("total_sales", "revenue", "avg_sales", "total_inventory_value")


def inventory_table(
    inventory_turnover: DataFrame, limit: int | None = TURNOVER_ROWS
) -> DataFrame:
    """Turnover of the first products by name."""
    first = first_rows(inventory_turnover, "product_name", limit=limit)
    return first.select("product_name", "inventory_turnover")


def monetary_histogram(rfm: DataFrame, width: float = BUCKET_WIDTH) -> DataFrame:
    """Customers per bucket of their monetary value, by the bucket's lower bound."""
    bucket = (F.floor(F.col("monetary").cast("double") / width) * width).cast("double")
    return rfm.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("customers"))


def profitability_trend(product_profitability: DataFrame) -> DataFrame:
    """Straight line of discount over sales, through all products over all batches."""
    points = profit_by_product(product_profitability)
    line = (F.col("total_discount_amount").cast("double"), F.col("total_sales_amount").cast("double"))
    return points.agg(
        F.regr_slope(*line).alias("slope"),
        F.regr_intercept(*line).alias("intercept"),
        F.regr_r2(*line).alias("r2"),
        F.regr_count(*line).alias("points"),
    )


def sample_locations(
    location_performance: DataFrame, k: int = LOCATIONS_SHOWN, seed: int = 0
) -> DataFrame:
    """Some locations, drawn at random; another seed gives another draw."""
    return sampled(location_table(location_performance), "location_store", k, seed)
