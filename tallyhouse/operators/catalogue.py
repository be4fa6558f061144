"""The metrics by name: what each reads, how it is computed and how it is stored."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyhouse.operators import customer, kpi, place, product

APPEND = "append"
REPLACE = "replace"


@dataclass(frozen=True)
class Metric:
    """A metric and the event columns it reads, by the use it makes of them.

    ``mode`` says whether a reader of the stored table sees all batches or the newest one.
    ``row_uuid`` adds a random id to each stored row.
    """

    name: str
    table: str
    compute: Callable[..., DataFrame]
    keys: tuple[str, ...] = ()
    sums: tuple[str, ...] = ()
    counts: tuple[str, ...] = ()
    maxes: tuple[str, ...] = ()
    distincts: tuple[str, ...] = ()
    mode: str = APPEND
    row_uuid: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        uses = self.keys + self.sums + self.counts + self.maxes + self.distincts
        return tuple(dict.fromkeys(uses))


_SALES = ("total_sales_amount", "quantity_sold")
_PROFIT = (
    "total_sales_amount",
    "discount_amount",
    "tax_amount",
    "shipping_fee",
    "quantity_sold",
)
_USAGE = {
    "keys": ("customer_id",),
    "sums": ("session_duration",),
    "counts": ("feature_accessed",),
    "distincts": ("session_id",),
}

METRICS: dict[str, Metric] = {
    metric.name: metric
    for metric in (
        Metric(
            "kpi_summary",
            "revenue_total_sales",
            kpi.kpi_summary,
            sums=("total_sales_amount", "discount_amount", "quantity_sold"),
            counts=("order_id",),
            mode=REPLACE,
            row_uuid=True,
        ),
        Metric(
            "customer_lifetime_value",
            "customer_lifetime_value",
            customer.customer_lifetime_value,
            keys=("customer_id",),
            sums=("total_sales_amount",),
        ),
        Metric(
            "website_traffic",
            "website_traffic",
            kpi.website_traffic,
            distincts=("customer_id",),
            row_uuid=True,
        ),
        Metric(
            "transaction_status_share",
            "bounce_rate",
            kpi.transaction_status_share,
            keys=("transaction_status",),
            counts=("order_id",),
            row_uuid=True,
        ),
        Metric(
            "stock_sold",
            "stock_levels",
            product.stock_sold,
            keys=("product_name",),
            sums=("quantity_sold",),
            row_uuid=True,
        ),
        Metric(
            "inventory_turnover",
            "inventory_turnover",
            product.inventory_turnover,
            keys=("product_name",),
            sums=("quantity_sold",),
            distincts=("transaction_date_readable",),
            mode=REPLACE,
        ),
        Metric(
            "gender_counts",
            "gender_counts",
            customer.gender_counts,
            keys=("gender",),
            counts=("customer_id",),
        ),
        Metric(
            "age_groups",
            "age_group",
            customer.age_groups,
            keys=("age",),
            counts=("customer_id",),
        ),
        Metric(
            "payment_method_counts",
            "payment_method_counts",
            customer.payment_method_counts,
            keys=("payment_method",),
            counts=("customer_id",),
        ),
        Metric(
            "top_selling_products",
            "top_selling_products",
            product.top_selling_products,
            keys=("product_name",),
            sums=("quantity_sold",),
        ),
        Metric(
            "product_performance",
            "product_performance",
            product.product_performance,
            keys=("product_name", "transaction_date_readable"),
            sums=_SALES,
            mode=REPLACE,
        ),
        Metric(
            "product_profitability",
            "product_profitability",
            product.product_profitability,
            keys=("product_name",),
            sums=_PROFIT,
        ),
        Metric(
            "sales_rep_performance",
            "sales_rep_performance",
            place.sales_rep_performance,
            keys=("sales_representative",),
            sums=_SALES,
        ),
        Metric(
            "location_performance",
            "location_performance",
            place.location_performance,
            keys=("location_store",),
            sums=_SALES,
            mode=REPLACE,
        ),
        Metric(
            "avg_order_value",
            "avg_order_value",
            place.avg_order_value,
            keys=("location_store",),
            sums=("total_sales_amount",),
            distincts=("order_id",),
        ),
        Metric(
            "rfm",
            "rfm",
            customer.rfm,
            keys=("customer_id",),
            sums=("total_sales_amount",),
            maxes=("transaction_date",),
            distincts=("order_id",),
            mode=REPLACE,
        ),
        Metric("app_usage", "app_usage_analysis", customer.app_usage, **_USAGE),
        Metric("avg_session_duration", "avg_session_duration", customer.avg_session_duration, **_USAGE),
    )
}

# Not stored: the exact count that bounds the approximate one.
TRAFFIC_EXACT = Metric(
    "website_traffic_exact", "", kpi.website_traffic_exact, distincts=("customer_id",)
)


def columns_of(metrics: Iterable[Metric]) -> tuple[str, ...]:
    """All event columns that any of the metrics reads."""
    return tuple(dict.fromkeys(name for metric in metrics for name in metric.columns))
