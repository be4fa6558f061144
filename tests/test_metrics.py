"""The metrics on hand-made events, and on combined frames made of them."""

from dataclasses import replace
from decimal import Decimal

import pytest
from events_fixture import EVENTS, SCHEMA
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import age_group, as_doubles
from tallyhouse.operators import customer, kpi, place, product, ranking
from tallyhouse.operators.catalogue import METRICS, columns_of
from tallyhouse.operators.combining import combine
from tallyhouse.plans.microbatch import compute_metric, metric_groups


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def by_key(df):
    return {row[0]: tuple(row)[1:] for row in df.collect()}


@pytest.mark.parametrize(
    ("age", "group"),
    [
        (None, "Unknown"),
        (17, "Unknown"),
        (18, "Young Age"),
        (35, "Young Age"),
        (36, "Middle Age"),
        (60, "Middle Age"),
        (61, "Old Age"),
    ],
)
def test_age_groups_at_their_edges(spark, age, group):
    ages = spark.createDataFrame([(age,)], "age int")
    assert ages.select(age_group(F.col("age"))).first()[0] == group


def test_kpi_summary_divides_by_events_with_an_order(sales):
    row = as_doubles(kpi.kpi_summary(sales)).first()
    assert row.total_sales == 282.8
    assert row.revenue == 275.8
    assert row.avg_sales == pytest.approx(282.8 / 6)
    assert row.total_inventory_value == 28


def test_kpi_summary_without_events(sales):
    assert tuple(kpi.kpi_summary(sales.limit(0)).first()) == (None, None, None, None)


def test_status_share_counts_orders_over_all_events(sales):
    shares = by_key(kpi.transaction_status_share(sales))
    assert shares["Successful"] == (5, pytest.approx(5 / 7 * 100))
    assert shares[None] == (0, 0.0)


def test_status_shares_add_up_when_every_event_has_an_order(sales):
    whole = kpi.transaction_status_share(sales.where("order_id IS NOT NULL"))
    assert whole.agg(F.sum("bounce_rate")).first()[0] == pytest.approx(100)


def test_null_group_keys_form_a_group(sales):
    assert by_key(product.stock_sold(sales))[None] == (6,)
    assert by_key(customer.gender_counts(sales))[None] == (1,)


def test_turnover_counts_distinct_moments(sales):
    assert by_key(product.inventory_turnover(sales))["bolt"] == (6.0,)


def test_order_value_is_null_without_orders(sales):
    values = by_key(place.avg_order_value(sales))
    assert values["Assam"] == (None,)
    assert values["Goa"] == (pytest.approx(60.6 / 2),)


def test_profit_subtracts_all_deductions(sales):
    ring = by_key(as_doubles(product.product_profitability(sales)))["ring"]
    assert ring == (30.3, 2.0, 1.0, 10.0, 3, pytest.approx(17.3))


def test_rfm_has_fractional_days_and_distinct_orders(sales):
    scores = by_key(as_doubles(customer.rfm(sales, as_of=3 * 86400 + 43200)))
    assert scores[1] == (2, 60.6, 1.5)


def test_recency_counts_to_now_by_default(sales):
    assert by_key(customer.rfm(sales))[1][2] > 20_000


def test_app_usage_ignores_unreadable_durations(sales):
    usage = by_key(customer.app_usage(sales))
    assert usage[1] == (2, 900.0, 2)
    assert usage[2] == (1, 300.0, 2)


def test_session_average_times_sessions_is_the_duration(sales):
    usage, average = by_key(customer.app_usage(sales)), by_key(customer.avg_session_duration(sales))
    for who, (sessions, duration, _) in usage.items():
        assert average[who][0] * sessions == pytest.approx(duration)


def test_customer_counts_agree(sales):
    counts = [customer.gender_counts, customer.age_groups, customer.payment_method_counts]
    totals = {count(sales).agg(F.sum("customer_count")).first()[0] for count in counts}
    assert totals == {6}


def test_ranking_breaks_ties_and_cuts(sales):
    ranked = ranking.ranked(product.stock_sold(sales), "stock_sold", "product_name", limit=2)
    assert [tuple(row) for row in ranked.collect()] == [("bolt", 12), ("nut", 7)]


def test_sample_is_the_same_for_any_partitioning(sales):
    places = place.location_performance(sales)
    draws = [
        rows(ranking.sampled(places.repartition(n), "location_store", 2, seed=7)) for n in (1, 3)
    ]
    assert draws[0] == draws[1] and len(draws[0]) == 2


@pytest.mark.parametrize("name", sorted(METRICS))
def test_metric_on_combined_events(sales, name):
    metric = METRICS[name]
    frame = combine(
        sales,
        metric.keys + metric.distincts,
        sums=metric.sums,
        counts=metric.counts,
        maxes=metric.maxes,
    )
    assert rows(compute_metric(metric, frame, 10**9)) == rows(compute_metric(metric, sales, 10**9))


def test_fused_metrics_equal_single_ones(sales):
    events = sales.select(*columns_of(METRICS.values()))
    groups = metric_groups(events)
    assert sum(len(group.metrics) for group in groups) == len(METRICS)
    for group in groups:
        for metric in group.metrics:
            fused = rows(compute_metric(metric, group.frame, 10**9))
            assert fused == rows(compute_metric(metric, events, 10**9)), metric.name


def test_fused_metrics_on_skewed_events(spark):
    """A third of all events belong to one customer, product, location and order."""
    hot = [replace_at(EVENTS[0], amount=Decimal(n)) for n in range(1000)]
    cold = [
        replace_at(EVENTS[3], order=f"c{n}", amount=Decimal(n), customer=n) for n in range(2000)
    ]
    skewed = spark.createDataFrame(hot + cold, SCHEMA)
    for group in metric_groups(skewed):
        for metric in group.metrics:
            fused = rows(compute_metric(metric, group.frame, 10**9))
            assert fused == rows(compute_metric(metric, skewed, 10**9)), metric.name
    values = by_key(customer.customer_lifetime_value(skewed))
    assert values[1] == (float(sum(range(1000))) + 1,)


def replace_at(event, order=None, amount=None, customer=None):
    event = list(event)
    event[0] = order or event[0]
    event[4] = amount if amount is not None else event[4]
    event[10] = customer if customer is not None else event[10]
    return tuple(event)


def test_metrics_may_be_computed_for_many_batches_at_once(sales):
    batched = sales.withColumn("micro_batch_id", F.col("quantity_sold") % 2)
    stored = product.stock_sold(batched, by=["micro_batch_id"])
    assert stored.columns == ["micro_batch_id", "product_name", "stock_sold"]
    assert rows(stored.where("product_name = 'bolt'")) == [(0, "bolt", 4), (1, "bolt", 8)]


def test_metric_keeps_its_spec_when_a_key_is_added():
    metric = replace(METRICS["stock_sold"], keys=("product_name", "micro_batch_id"))
    assert metric.columns == ("product_name", "micro_batch_id", "quantity_sold")
