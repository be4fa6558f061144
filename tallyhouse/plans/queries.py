"""The registered queries: each operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.folders import kept, own_folder
from tallyhouse.functions.scalars import as_doubles
from tallyhouse.operators import distribution, mergeable, regression
from tallyhouse.operators.catalogue import METRICS, TRAFFIC_EXACT, Metric
from tallyhouse.operators.ranking import ranked
from tallyhouse.plans import csv_report, insights, serving
from tallyhouse.schema import BATCH_COLUMN, EVENT_FIELDS, MONEY_COLUMNS
from tallyhouse.sinks.metrics import store_metric
from tallyhouse.sinks.publishing import to_kafka_records, to_wire
from tallyhouse.sources import events
from tallyhouse.sources.metric_store import read_metric
from tallyhouse.sources.tables import combined_sales, key_violations, sales_view

Query = Callable[[SparkSession, str], DataFrame]

# 2001-09-09, after the newest order: recency must not depend on the day of the run.
AS_OF = 1_000_000_000

# Ratios are compared with SQL results to this many digits.
_DIGITS = 6


def rounded(df: DataFrame, *columns: str, digits: int = _DIGITS) -> DataFrame:
    rounds = {name: F.round(name, digits) for name in columns}
    return df.withColumns(rounds) if rounds else df


def metric_over_tables(spark: SparkSession, path: str, metric: Metric, **options) -> DataFrame:
    return metric.compute(combined_sales(spark, path, metric), **options)


def _metric(name: str, *ratios: str, rank: tuple[str, ...] = (), **options) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        result = metric_over_tables(spark, path, METRICS[name], **options)
        result = rounded(as_doubles(result), *ratios)
        return ranked(result, *rank) if rank else result

    return run


def _traffic_exact(spark: SparkSession, path: str) -> DataFrame:
    return metric_over_tables(spark, path, TRAFFIC_EXACT)


def _status_share(spark: SparkSession, path: str) -> DataFrame:
    everyone = sales_view(spark, path, columns=())
    metric = METRICS["transaction_status_share"]
    return rounded(metric_over_tables(spark, path, metric, population=everyone), "bounce_rate")


METRIC_QUERIES: dict[str, Query] = {
    "kpi_summary": _metric("kpi_summary", "avg_sales"),
    "customer_lifetime_value": _metric("customer_lifetime_value"),
    "website_traffic": _metric("website_traffic"),
    "website_traffic_exact": _traffic_exact,
    "transaction_status_share": _status_share,
    "stock_sold": _metric("stock_sold"),
    "inventory_turnover": _metric("inventory_turnover", "inventory_turnover"),
    "gender_counts": _metric("gender_counts"),
    "age_groups": _metric("age_groups"),
    "payment_method_counts": _metric("payment_method_counts"),
    "top_selling_products": _metric(
        "top_selling_products", rank=("total_quantity_sold", "product_name")
    ),
    "product_performance": _metric("product_performance"),
    "product_profitability": _metric("product_profitability", rank=("profit", "product_name")),
    "sales_rep_performance": _metric(
        "sales_rep_performance", rank=("total_sales_amount", "sales_representative")
    ),
    "location_performance": _metric(
        "location_performance", rank=("total_sales_amount", "location_store")
    ),
    "avg_order_value": _metric(
        "avg_order_value", "average_order_value", rank=("average_order_value", "location_store")
    ),
    "rfm": _metric("rfm", "recency", as_of=AS_OF),
    "app_usage": _metric("app_usage"),
    "avg_session_duration": _metric("avg_session_duration", "avg_session_duration"),
}


def _by_batch(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows that a metric's table holds after several batches. The n-th line of every order
    belongs to batch n, so orders and customers reach over batches; no line is left out."""
    metric = METRICS[name]
    batched = replace(metric, keys=(*metric.keys, BATCH_COLUMN))
    return metric.compute(combined_sales(spark, path, batched), by=[BATCH_COLUMN])


def _cumulative(name: str, keys: list[str], sums: list[str]) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        return as_doubles(serving.cumulative(_by_batch(spark, path, name), keys, sums))

    return run


CUMULATIVE_QUERIES: dict[str, Query] = {
    "cumulative_stock_sold": _cumulative("stock_sold", ["product_name"], ["stock_sold"]),
    "cumulative_age_groups": _cumulative("age_groups", ["age_group"], ["customer_count"]),
    "cumulative_top_selling_products": _cumulative(
        "top_selling_products", ["product_name"], ["total_quantity_sold"]
    ),
    "cumulative_product_profitability": _cumulative(
        "product_profitability",
        ["product_name"],
        [
            "total_sales_amount",
            "total_discount_amount",
            "total_tax_amount",
            "total_shipping_fee",
            "total_quantity_sold",
            "profit",
        ],
    ),
    "cumulative_sales_rep_performance": _cumulative(
        "sales_rep_performance",
        ["sales_representative"],
        ["total_sales_amount", "total_quantity_sold"],
    ),
    "cumulative_location_performance": _cumulative(
        "location_performance",
        ["location_store"],
        ["total_sales_amount", "total_quantity_sold"],
    ),
}


def _states(spark: SparkSession, path: str, state: mergeable.State) -> DataFrame:
    """The states that are stored after several batches, as in :func:`_by_batch`: orders, customers and moments
    reach over batches."""
    combined = combined_sales(spark, path, mergeable.state_metric(state, [BATCH_COLUMN]))
    return mergeable.state_of(combined, state, by=[BATCH_COLUMN])


def _over_batches(name: str, *ratios: str, **options) -> Query:
    """A metric that counts distinct values, from the states of several batches."""

    def run(spark: SparkSession, path: str) -> DataFrame:
        states = _states(spark, path, mergeable.STATE_OF[name]).drop(BATCH_COLUMN)
        return rounded(as_doubles(mergeable.over_batches(states, name, **options)), *ratios)

    return run


def _traffic_over_batches(spark: SparkSession, path: str) -> DataFrame:
    """Customers by the merged sketches of several batches: the exact number, and whether the approximate one is
    within 5 % of it."""
    sales = sales_view(spark, path, ("customer_id", BATCH_COLUMN))
    near = mergeable.traffic_over_batches(mergeable.traffic_sketch(sales, [BATCH_COLUMN]))
    exact = _traffic_exact(spark, path).select(F.col("website_traffic").alias("exact"))
    off = F.abs(near.select("website_traffic").scalar() - F.col("exact"))
    return exact.withColumn("is_near", off <= 0.05 * F.col("exact"))


STATE_QUERIES: dict[str, Query] = {
    "cumulative_avg_order_value": _over_batches("avg_order_value", "average_order_value"),
    "cumulative_rfm": _over_batches("rfm", "recency", as_of=AS_OF),
    "cumulative_inventory_turnover": _over_batches("inventory_turnover", "inventory_turnover"),
    "cumulative_app_usage": _over_batches("app_usage"),
    "cumulative_avg_session_duration": _over_batches("avg_session_duration", "avg_session_duration"),
    "cumulative_website_traffic_check": _traffic_over_batches,
}


def _two_batches(spark: SparkSession, path: str, columns: tuple[str, ...]) -> list[DataFrame]:
    """The sales in two batches, by odd and even line numbers."""
    sales = sales_view(spark, path, (*columns, BATCH_COLUMN))
    return [sales.where(F.col(BATCH_COLUMN) % 2 == part).drop(BATCH_COLUMN) for part in (0, 1)]


def _stored_append(spark: SparkSession, path: str) -> DataFrame:
    """Two appended batches of a metric, written to a store and read back."""
    metric, root = METRICS["gender_counts"], own_folder(spark, "store")
    for batch_id, sales in enumerate(_two_batches(spark, path, metric.columns)):
        store_metric(metric.compute(sales), root, metric.table, batch_id)
    return serving.gender_totals(read_metric(spark, root, metric.table))


def _stored_replace(spark: SparkSession, path: str) -> DataFrame:
    """Two batches of a replaced metric, of which readers see the newest, that of all sales."""
    metric, root = METRICS["kpi_summary"], own_folder(spark, "store")
    first, _ = _two_batches(spark, path, metric.columns)
    for batch_id, sales in enumerate((first, combined_sales(spark, path, metric))):
        store_metric(metric.compute(sales), root, metric.table, batch_id, keep=2)
    newest = serving.latest_kpis(read_metric(spark, root, metric.table, latest=True))
    return rounded(as_doubles(newest), "avg_sales")


def _stored_states(spark: SparkSession, path: str) -> DataFrame:
    """States of two batches, written to a store, read back and merged."""
    state, root = mergeable.STATE_OF["avg_order_value"], own_folder(spark, "store")
    for batch_id, sales in enumerate(_two_batches(spark, path, state.metric.columns)):
        store_metric(mergeable.state_of(sales, state), root, state.table, batch_id)
    merged = mergeable.over_batches(read_metric(spark, root, state.table), "avg_order_value")
    return rounded(as_doubles(merged), "average_order_value")


STORE_QUERIES: dict[str, Query] = {
    "stored_gender_totals": _stored_append,
    "stored_latest_kpis": _stored_replace,
    "stored_avg_order_value": _stored_states,
}


def _quantiles_check(spark: SparkSession, path: str) -> DataFrame:
    """Quantiles of the customers' monetary values from merged sketches of 16 groups of customers: whether the
    share of customers that do not exceed each is within 3 % of the share it stands for."""
    rfm = metric_over_tables(spark, path, METRICS["rfm"], as_of=AS_OF).select("customer_id", "monetary")
    rfm = kept(rfm.withColumn("group", F.pmod("customer_id", F.lit(16))), "rfm")
    found = distribution.monetary_quantiles(distribution.monetary_sketch(rfm, ["group"]))
    shares = found.agg(F.array_sort(F.collect_list(F.struct("share", "monetary"))).alias("all"))
    each = [
        F.count_if(F.col("monetary").cast("double") <= F.get(shares.scalar(), F.lit(i))["monetary"]).alias(f"n{i}")
        for i in range(len(distribution.SHARES))
    ]
    counted = rfm.agg(F.count("*").alias("customers"), *each)
    rows = [
        F.struct(
            F.lit(share).alias("share"),
            (F.abs(F.col(f"n{i}") / F.col("customers") - share) <= 0.03).alias("is_near"),
        )
        for i, share in enumerate(distribution.SHARES)
    ]
    return counted.select("customers", F.inline(F.array(*rows)))


def _histogram_check(spark: SparkSession, path: str) -> DataFrame:
    """The histogram from a sketch: all customers are in it, and the largest bucket holds about as many as it does
    by an exact count."""
    rfm = kept(metric_over_tables(spark, path, METRICS["rfm"], as_of=AS_OF).select("monetary"), "rfm")
    sketched = distribution.sketched_histogram(distribution.monetary_sketch(rfm), 50_000.0)
    exact = serving.monetary_histogram(rfm, 50_000.0)
    both = exact.withColumnRenamed("customers", "exact").join(sketched, "bucket", "full")
    off = F.abs(F.coalesce("exact", F.lit(0)) - F.coalesce("customers", F.lit(0)))
    return both.agg(
        F.sum("exact").alias("customers"), (F.max(off) <= 0.04 * F.sum("exact")).alias("is_near")
    )


SKETCH_QUERIES: dict[str, Query] = {
    "monetary_quantiles_check": _quantiles_check,
    "monetary_histogram_check": _histogram_check,
}


def _serving(name: str, serve: Callable[[DataFrame], DataFrame], *ratios: str, **options) -> Query:
    """A dashboard query over a replaced metric, whose newest batch is the whole table."""

    def run(spark: SparkSession, path: str) -> DataFrame:
        served = serve(metric_over_tables(spark, path, METRICS[name], **options))
        return rounded(as_doubles(served), *ratios)

    return run


def _serving_batches(name: str, serve: Callable[[DataFrame], DataFrame]) -> Query:
    """A dashboard query over an appended metric of several batches."""

    def run(spark: SparkSession, path: str) -> DataFrame:
        return as_doubles(serve(_by_batch(spark, path, name)))

    return run


def _trend(points: DataFrame) -> DataFrame:
    line = serving.profitability_trend(points)
    return rounded(rounded(line, "slope", "r2"), "intercept", digits=1)


def _insights(spark: SparkSession, path: str) -> DataFrame:
    """The report from the metrics of the whole tables. Lines of the turnover list keep their
    figures only: how a ratio prints differs between engines in the last digit."""

    def rows(name: str) -> DataFrame:
        options = {"as_of": AS_OF} if name == "rfm" else {}
        return metric_over_tables(spark, path, METRICS[name], **options)

    report = insights.insights_report({name: rows(name) for name in insights.REPORT_METRICS})
    text = F.when(F.col("section") < len(insights.SECTIONS), F.col("text"))
    return rounded(report.where("metric IS NOT NULL").withColumn("text", text), "value")


def _lines_of_figures(report: DataFrame) -> DataFrame:
    """The lines with a figure and their text; lines with quantities keep their figures only, as their numbers
    print as doubles, which engines do not print alike."""
    text = F.when(~F.col("metric").isin("total_quantity", "average_quantity") & (F.col("section") != 3), F.col("text"))
    return rounded(report.where("metric IS NOT NULL").withColumn("text", text), "value")


SERVING_QUERIES: dict[str, Query] = {
    "gender_totals": _serving_batches("gender_counts", serving.gender_totals),
    "product_performance_series": _serving(
        "product_performance", serving.product_performance_series
    ),
    "profitability_points": _serving_batches("product_profitability", serving.profitability_points),
    "payment_method_table": _serving_batches("payment_method_counts", serving.payment_method_table),
    "location_table": _serving("location_performance", serving.location_table),
    "monetary_values": _serving("rfm", serving.monetary_values, as_of=AS_OF),
    "latest_kpis": _serving("kpi_summary", serving.latest_kpis, "avg_sales"),
    "inventory_table": _serving(
        "inventory_turnover", serving.inventory_table, "inventory_turnover"
    ),
    "monetary_histogram": _serving("rfm", serving.monetary_histogram, as_of=AS_OF),
    "profitability_trend": _serving("product_profitability", _trend),
    "sample_locations": _serving("location_performance", serving.sample_locations),
    "insights_report": _insights,
}

# Names under which the sales stand in for an uploaded table.
UPLOADED = {
    "transaction_date_readable": "Date",
    "total_sales_amount": "Amount",
    "quantity_sold": "Qty",
    "product_name": "SKU",
    "payment_method": "currency",
    "feature_accessed": "Courier Status",
    "transaction_status": "Status",
    "gender": "fulfilled-by",
}


def uploaded_view(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The sales as an uploaded table, with the asked columns of :data:`UPLOADED`, or all."""
    sales = sales_view(spark, path, columns or tuple(UPLOADED))
    return sales.withColumnsRenamed(UPLOADED)


def _uploaded(section: Callable[[DataFrame], DataFrame], columns: list[str], *ratios: str) -> Query:
    def run(spark: SparkSession, path: str) -> DataFrame:
        return rounded(section(uploaded_view(spark, path, *columns)), *ratios)

    return run


def _uploaded_report(spark: SparkSession, path: str) -> DataFrame:
    """Only the ranking reads the products, so the pass over all distributions does not join them."""
    ranked_by = ["product_name", "quantity_sold", "total_sales_amount"]
    rest = [name for name in UPLOADED if name != "product_name"]
    products = uploaded_view(spark, path, *ranked_by)
    report = csv_report.csv_report(uploaded_view(spark, path, *rest), products=products)
    return _lines_of_figures(report)


CSV_QUERIES: dict[str, Query] = {
    "csv_sales_overview": _uploaded(
        csv_report.csv_sales_overview, ["total_sales_amount"], "average_order_value"
    ),
    "csv_daily_sales": _uploaded(
        csv_report.csv_daily_sales, ["transaction_date_readable", "total_sales_amount"]
    ),
    "csv_top_skus": _uploaded(
        csv_report.csv_top_skus, ["product_name", "quantity_sold", "total_sales_amount"]
    ),
    "csv_fulfillment": _uploaded(csv_report.csv_fulfillment, ["gender"]),
    "csv_courier_status": _uploaded(
        csv_report.csv_courier_status, ["feature_accessed", "transaction_status"]
    ),
    "csv_order_status": _uploaded(
        csv_report.csv_order_status, ["feature_accessed", "transaction_status"]
    ),
    "csv_quantity": _uploaded(csv_report.csv_quantity, ["quantity_sold"], "average_quantity"),
    "csv_financials": _uploaded(
        csv_report.csv_financials, ["total_sales_amount", "quantity_sold"], "profit_margin_percent"
    ),
    "csv_currency": _uploaded(csv_report.csv_currency, ["payment_method", "total_sales_amount"]),
    "csv_report": _uploaded_report,
}


def _enriched(spark: SparkSession, path: str) -> DataFrame:
    """Amount, readable date and session end of events that came without them."""
    raw = sales_view(
        spark,
        path,
        ("sales_id", "quantity_sold", "unit_price", "transaction_date", "session_duration"),
    )
    return events.enrich_events(raw).select(
        "sales_id",
        "session_duration",
        F.col("total_sales_amount").cast("double").alias("total_sales_amount"),
        "transaction_date_readable",
        "session_end",
    )


def _ingested(spark: SparkSession, path: str) -> DataFrame:
    """Figures of the events after all of them were written as JSON messages and parsed again."""
    names = [name for _, name, _ in EVENT_FIELDS]
    messages = to_kafka_records(to_wire(sales_view(spark, path, names)), "Sales ID")
    parsed = events.parse_events(messages)
    counted = [name for name in names if name not in MONEY_COLUMNS]
    return parsed.groupBy("transaction_type", "payment_method").agg(
        *[F.count(name).alias(f"{name}_rows") for name in counted],
        *[F.sum(name).cast("double").alias(name) for name in MONEY_COLUMNS],
        F.sum("age").alias("age"),
        F.sum("transaction_date").alias("transaction_date"),
        F.max("transaction_date_readable").alias("newest"),
        F.min("sales_id").alias("first_sales_id"),
    )


# The model of a session's tables and the sales it was fitted to, by application and path.
_FITTED: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def _predictions(spark: SparkSession, path: str) -> DataFrame:
    """The sales are joined once, and the model is fitted once, stored, and loaded by every query that predicts."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _FITTED:
        sales = kept(sales_view(spark, path, regression.MODEL_COLUMNS), "sales")
        where = f"{own_folder(spark, 'model')}/model"
        regression.fit_sales_model(sales).write().save(where)
        _FITTED[key] = (where, sales)
    where, sales = _FITTED[key]
    return regression.predict_sales(PipelineModel.load(where), sales)


def _mse(spark: SparkSession, path: str) -> DataFrame:
    return regression.regression_mse(_predictions(spark, path))


def _traffic_check(spark: SparkSession, path: str) -> DataFrame:
    """The exact number of customers, and whether the approximate one is within 15 % of it."""
    exact = _traffic_exact(spark, path).select(F.col("website_traffic").alias("exact"))
    near = metric_over_tables(spark, path, METRICS["website_traffic"])
    off = F.abs(near.select("website_traffic").scalar() - F.col("exact"))
    return exact.withColumn("is_near", off <= 0.15 * F.col("exact"))


def _prediction_check(spark: SparkSession, path: str) -> DataFrame:
    """Rows and sum of the amounts, and whether every prediction is within their range."""
    label, prediction = F.col(regression.LABEL), F.col("prediction")
    return _predictions(spark, path).agg(
        F.count("*").alias("n_rows"),
        F.round(F.sum(label.cast("decimal(28,6)")).cast("double"), 2).alias("total_sales_amount"),
        ((F.min(prediction) >= F.min(label)) & (F.max(prediction) <= F.max(label))).alias("in_range"),
    )


def _error_check(spark: SparkSession, path: str) -> DataFrame:
    """Rows, and whether the error is at most 1 % above the variance of the amounts."""
    error = F.col(regression.LABEL) - F.col("prediction")
    return _predictions(spark, path).agg(
        F.count("*").alias("n_rows"),
        (F.avg(error * error) <= 1.01 * F.var_pop(regression.LABEL)).alias("error_is_small"),
    )


INGEST_QUERIES: dict[str, Query] = {"enriched_events": _enriched, "ingested_events": _ingested}
MODEL_QUERIES: dict[str, Query] = {
    "predict_sales": _predictions,
    "regression_mse": _mse,
    "predict_sales_check": _prediction_check,
    "regression_mse_check": _error_check,
}
CHECK_QUERIES: dict[str, Query] = {
    "website_traffic_check": _traffic_check,
    "key_violations": key_violations,
}


def all_queries() -> dict[str, Query]:
    return {
        **METRIC_QUERIES,
        **CUMULATIVE_QUERIES,
        **STATE_QUERIES,
        **STORE_QUERIES,
        **SKETCH_QUERIES,
        **SERVING_QUERIES,
        **CSV_QUERIES,
        **INGEST_QUERIES,
        **MODEL_QUERIES,
        **CHECK_QUERIES,
    }
