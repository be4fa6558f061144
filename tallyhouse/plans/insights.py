"""The dashboard's insight report over stored metrics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalars import money_shown, shown
from tallyhouse.operators.catalogue import METRICS, REPLACE, Metric
from tallyhouse.operators.distribution import monetary_quantiles
from tallyhouse.plans import serving
from tallyhouse.plans.reports import FIGURES, HEADING, figures, joined, remarks
from tallyhouse.schema import EVENT_FIELDS, MONEY, MONEY_COLUMNS
from tallyhouse.sources.metric_store import newest_batch, read_metric

# The metrics a report is made of, by the name of the metric.
REPORT_METRICS = (
    "payment_method_counts",
    "product_performance",
    "gender_counts",
    "rfm",
    "product_profitability",
    "location_performance",
    "kpi_summary",
    "inventory_turnover",
)

# Titles of the report and of its sections.
TITLE = "E-commerce Dashboard Insights Report"
SECTIONS = (
    "1. Payment Method Distribution Overview",
    "2. Product Performance Trends Analysis",
    "3. Customer Gender Distribution Overview",
    "4. Monetary Value Distribution Analysis",
    "5. Product Profitability Relationship Analysis",
    "6. Location Performance Comparison",
    "Key E-commerce Metrics",
    "Inventory Turnover Data",
)


def _headings(spark: SparkSession) -> DataFrame:
    lines = [(0, HEADING, TITLE)]
    lines += [(number, HEADING, title) for number, title in enumerate(SECTIONS, start=1)]
    return remarks(spark, lines)


def insights_report(
    metrics: Mapping[str, DataFrame],
    series_rows: int | None = serving.SERIES_ROWS,
    point_rows: int | None = serving.POINT_ROWS,
    turnover_rows: int | None = serving.TURNOVER_ROWS,
    monetary_sketches: DataFrame | None = None,
) -> DataFrame:
    """The report from the rows of its metrics: six lists, the key figures and the turnover.

    Three lists show their first rows only; None shows all. A figure that is missing prints as None,
    key figures as zero. The fourth section lists the monetary value of every customer, or, where sketches of
    them are given, quantiles, whose number does not grow with the customers.
    """
    payment = serving.payment_method_table(metrics["payment_method_counts"])
    series = serving.product_performance_series(metrics["product_performance"], series_rows)
    genders = serving.gender_totals(metrics["gender_counts"])
    monetary = serving.monetary_values(metrics["rfm"])
    points = serving.profitability_points(metrics["product_profitability"], point_rows)
    locations = serving.location_table(metrics["location_performance"])
    turnover = serving.inventory_table(metrics["inventory_turnover"], turnover_rows)
    kpis = serving.latest_kpis(metrics["kpi_summary"])
    # One row, also where no batch has been stored yet
    kpis = kpis.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in kpis.columns])

    # The wording of the lines.
    sales, nothing = F.col("total_sales_amount"), F.lit(None)
    parts = [
        _headings(payment.sparkSession),
        figures(
            payment,
            1,
            F.col("payment_method"),
            [("customer_count", F.col("customer_count"))],
            _line("{}: {} customers", shown(F.col("payment_method")), shown(F.col("customer_count"))),
        ),
        figures(
            series,
            2,
            F.col("transaction_date_readable"),
            [("total_sales_amount", sales), ("quantity_sold", F.col("quantity_sold"))],
            _line(
                "{}: Quantity Sold - {}, Total Sales - {}",
                shown(F.col("transaction_date_readable")),
                shown(F.col("quantity_sold")),
                money_shown(sales),
            ),
        ),
        *[
            figures(
                genders,
                3,
                F.lit(word.lower()),
                [("customer_count", F.col(f"{word.lower()}_count"))],
                _line(f"{word} Count - {{}} customers", shown(F.col(f"{word.lower()}_count"))),
                seq=FIGURES + place,
            )
            for place, word in enumerate(("Male", "Female"))
        ],
        _monetary_quantiles(monetary_sketches)
        if monetary_sketches is not None
        else figures(
            monetary,
            4,
            nothing,
            [("monetary", F.col("monetary"))],
            _line("Monetary - {}", money_shown(F.col("monetary"))),
        ),
        figures(
            points,
            5,
            nothing,
            [
                ("total_sales_amount", sales),
                ("total_discount_amount", F.col("total_discount_amount")),
            ],
            _line(
                "Total Sales - {}, Total Discount - {}",
                money_shown(sales),
                money_shown(F.col("total_discount_amount")),
            ),
        ),
        figures(
            locations,
            6,
            F.col("location_store"),
            [("total_sales_amount", sales), ("total_quantity_sold", F.col("total_quantity_sold"))],
            _line(
                "Location - {}, Total Sales - {}, Total Quantity Sold - {} units",
                shown(F.col("location_store")),
                money_shown(sales),
                shown(F.col("total_quantity_sold")),
            ),
        ),
        *[
            figures(
                kpis,
                7,
                nothing,
                [(name, F.col(name))],
                _line(f"{label}: {{}}", money_shown(F.col(name))),
                seq=FIGURES + place,
            )
            for place, (name, label) in enumerate(
                (
                    ("total_sales", "Total Sales"),
                    ("revenue", "Revenue"),
                    ("avg_sales", "Average Sales"),
                    ("total_inventory_value", "Total Inventory Value"),
                )
            )
        ],
        figures(
            turnover,
            8,
            F.col("product_name"),
            [("inventory_turnover", F.col("inventory_turnover"))],
            _line("| {} | {} |", shown(F.col("product_name")), shown(F.col("inventory_turnover"))),
        ),
    ]
    return joined(parts)


def _monetary_quantiles(sketches: DataFrame) -> DataFrame:
    share = F.format_number(F.col("share") * 100, 0)
    return figures(
        monetary_quantiles(sketches),
        4,
        F.format_number(F.col("share"), 2),
        [("monetary", F.col("monetary"))],
        _line("{} % of customers: at most {}", share, money_shown(F.col("monetary"))),
    )


def _line(form: str, *values: Column) -> Column:
    """The form with its places filled in."""
    texts = form.split("{}")
    rest = [part for value, text in zip(values, texts[1:], strict=True) for part in (value, F.lit(text))]
    return F.concat(F.lit(texts[0]), *rest)


def _schema_of(spark: SparkSession, metric: Metric) -> T.StructType:
    """Columns of a metric that has not been stored yet."""
    kinds = {name: kind for _, name, kind in EVENT_FIELDS}
    kinds |= dict.fromkeys(MONEY_COLUMNS, MONEY)
    fields = [T.StructField(name, kinds[name]) for name in metric.columns]
    return metric.compute(spark.createDataFrame([], T.StructType(fields))).schema


def stored_metrics(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The rows of the report's metrics as a reader of the store sees them, all as of one batch.
    Metrics without a batch have no rows."""
    newest = newest_batch(spark, root)
    return {
        name: read_metric(
            spark,
            root,
            METRICS[name].table,
            latest=METRICS[name].mode == REPLACE,
            empty_schema=_schema_of(spark, METRICS[name]),
            fmt=fmt,
            upto=newest,
        )
        for name in REPORT_METRICS
    }
