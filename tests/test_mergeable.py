"""Distinct counts and ratios over batches: merged states equal the metric over all events."""

import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import mergeable
from tallyhouse.operators.catalogue import METRICS
from tallyhouse.operators.distribution import monetary_quantiles, monetary_sketch, sketched_histogram
from tallyhouse.plans import insights, serving
from tallyhouse.plans.microbatch import compute_metric
from tallyhouse.sinks.metrics import store_metric
from tallyhouse.sources.metric_store import read_metric

SCHEMA = (
    "customer_id int, order_id string, session_id int, location_store string, product_name string, "
    "total_sales_amount decimal(28,6), quantity_sold int, transaction_date bigint, "
    "transaction_date_readable string, session_duration string, feature_accessed string"
)
# Ids that are no numbers, or numbers that print otherwise, and keys that are null
ORDERS = ["1", "01", "+1", " 1", "7", "32768", "32769", "9223372036854775807", "9223372036854775808", "-3", "A-1", "", None]


def events(spark, seed, n=300):
    draw = random.Random(seed)
    rows = [
        (
            draw.choice([1, 2, 3, None]),
            draw.choice(ORDERS),
            draw.choice([1, 2, 100, None]),
            draw.choice(["north", "south", None]),
            draw.choice(["bolt", "nut"]),
            draw.choice([None, 1]) and draw.randrange(10**6) / 100,
            draw.randrange(5),
            draw.randrange(10**6),
            draw.choice(["2024-01-01 00:00:00", "2024-01-02 10:00:00", "x", None]),
            draw.choice(["30", "4.5", "aa", "NaN", None]),
            draw.choice(["Home", None]),
        )
        for _ in range(n)
    ]
    from decimal import Decimal

    exact = [(*r[:5], None if r[5] is None else Decimal(str(r[5])), *r[6:]) for r in rows]
    return spark.createDataFrame(exact, SCHEMA)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(mergeable.STATE_OF))
def test_merged_states_equal_the_metric_over_all_events(spark, tmp_path, name):
    state, root = mergeable.STATE_OF[name], str(tmp_path / "m")
    batches = [events(spark, seed) for seed in range(3)]
    for batch_id, batch in enumerate(batches):
        store_metric(mergeable.state_of(batch, state), root, state.table, batch_id)
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])
    stored = read_metric(spark, root, state.table)
    metric = METRICS[name]
    expected = plain(compute_metric(metric, everything, 2_000_000))
    assert plain(compute_metric(metric, mergeable.merged(stored, state), 2_000_000)) == expected
    at_once = mergeable.state_of(everything.withColumn("b", F.col("quantity_sold") % 2), state, by=["b"])
    assert plain(compute_metric(metric, mergeable.merged(at_once, state), 2_000_000)) == expected


def test_state_of_a_dense_metric_is_short(spark):
    """100,000 orders of one location are four bitmaps."""
    many = spark.range(100_000).select(
        F.lit("north").alias("location_store"),
        F.col("id").cast("string").alias("order_id"),
        F.lit(1).cast("decimal(28,6)").alias("total_sales_amount"),
    )
    state = mergeable.STATE_OF["avg_order_value"]
    rows = mergeable.state_of(many.unionByName(many), state)
    # The number 0 has a range of its own, the others four of 32,768 numbers
    assert rows.count() == 5
    assert mergeable.over_batches(rows, "avg_order_value").first().average_order_value == 2.0


def test_states_of_no_events(spark):
    none = events(spark, 0).limit(0)
    for name, state in mergeable.STATE_OF.items():
        merged = mergeable.merged(mergeable.state_of(none, state), state)
        assert compute_metric(METRICS[name], merged, 0).count() == 0


def test_traffic_of_several_batches(spark):
    def sketch(first, end):
        return mergeable.traffic_sketch(spark.range(first, end).select(F.col("id").alias("customer_id")))

    both = sketch(0, 20_000).unionByName(sketch(10_000, 30_000))
    assert abs(mergeable.traffic_over_batches(both).first()[0] - 30_000) < 1_500
    assert mergeable.traffic_over_batches(both.limit(0)).first()[0] == 0


def test_quantiles_and_histogram_of_merged_sketches(spark):
    customers = spark.range(50_000).select(F.col("id").cast("double").alias("monetary"), (F.col("id") % 7).alias("batch"))
    sketches = monetary_sketch(customers, ["batch"])
    assert sketches.count() == 7
    for row in monetary_quantiles(sketches).collect():
        assert abs(row.monetary / 50_000 - row.share) < 0.03 and row.customers == 50_000
    buckets = {r.bucket: r.customers for r in sketched_histogram(sketches, 5_000).collect()}
    assert sorted(buckets) == [5_000.0 * n for n in range(10)]
    assert all(abs(n - 5_000) < 1_500 for n in buckets.values())
    assert sketched_histogram(sketches, 0.001, most_buckets=20).count() <= 21
    assert monetary_quantiles(sketches.limit(0)).count() == 0


def test_small_sketches_are_exact(spark):
    rows = spark.createDataFrame([(10.0,), (49.0,), (50.0,), (120.0,), (None,)], "monetary double")
    sketched = {r.bucket: r.customers for r in sketched_histogram(monetary_sketch(rows), 50).collect()}
    exact = {r.bucket: r.customers for r in serving.monetary_histogram(rows.dropna()).collect()}
    assert sketched == exact


def test_report_with_sketches_lists_quantiles_only(spark):
    metrics = insights.stored_metrics(spark, "/tmp/no-such-store")
    rows = spark.range(5_000).select(F.col("id").cast("double").alias("monetary"))
    report = insights.insights_report(metrics, monetary_sketches=monetary_sketch(rows))
    lines = [r.text for r in report.where("section = 4 AND metric = 'monetary'").orderBy("key").collect()]
    assert len(lines) == 8 and lines[-1] == "100 % of customers: at most $4,999.00"
