"""The view over the star schema: joins left out, joins enforced, and the plans they give."""

import pytest

from tallyhouse.operators.catalogue import METRICS
from tallyhouse.plans.microbatch import compute_metric
from tallyhouse.sources.tables import ENFORCED, SALES_COLUMNS, combined_sales, key_violations, sales_view

PATH = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    """The tables with line items that point to no order or part."""
    folder = str(tmp_path_factory.mktemp("dirty"))
    for name in ("orders", "customer", "nation", "part", "supplier"):
        spark.read.parquet(f"{PATH}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    lines = spark.read.parquet(f"{PATH}/lineitem.parquet")
    lost = lines.limit(10).selectExpr("l_orderkey + 1000000 AS l_orderkey", "* EXCEPT (l_orderkey)")
    lines.unionByName(lost).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The tables with a third of all line items on one order, part and supplier."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in ("orders", "customer", "nation", "part", "supplier"):
        spark.read.parquet(f"{PATH}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    hot = "if(l_linenumber <= 2, 1, {0}) AS {0}"
    keys = [hot.format(key) for key in ("l_orderkey", "l_partkey", "l_suppkey")]
    spark.read.parquet(f"{PATH}/lineitem.parquet").selectExpr(
        *keys, "* EXCEPT (l_orderkey, l_partkey, l_suppkey)"
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_all_columns(spark):
    view = sales_view(spark, PATH)
    assert view.columns == list(SALES_COLUMNS) and view.count() == 6000


def test_trusted_and_enforced_keys_agree_on_clean_tables(spark):
    trusted = sales_view(spark, PATH)
    enforced = sales_view(spark, PATH, foreign_keys=ENFORCED)
    assert rows(trusted) == rows(enforced)


def test_key_violations(spark, dirty):
    assert {row.rows for row in key_violations(spark, PATH).collect()} == {0}
    found = {(r.foreign_key, r.problem): r.rows for r in key_violations(spark, dirty).collect()}
    assert found["lineitem.l_orderkey", "dangling"] == 10
    assert sum(found.values()) == 10


def test_enforced_keys_drop_dangling_lines(spark, dirty):
    columns = ["quantity_sold"]
    assert sales_view(spark, dirty, columns).count() == 6010
    assert sales_view(spark, dirty, columns, ENFORCED).count() == 6000
    metric = METRICS["stock_sold"]
    kept = rows(metric.compute(combined_sales(spark, dirty, metric, ENFORCED)))
    assert kept == rows(metric.compute(sales_view(spark, PATH, metric.columns)))


@pytest.fixture(scope="module")
def skewed_view(spark, skewed):
    view = sales_view(spark, skewed, foreign_keys=ENFORCED).persist()
    yield view
    view.unpersist()


@pytest.mark.parametrize("name", sorted(METRICS))
def test_combined_view_gives_the_same_metric_under_skew(spark, skewed, skewed_view, name):
    metric = METRICS[name]
    combined = compute_metric(metric, combined_sales(spark, skewed, metric), 10**9)
    assert rows(combined) == rows(compute_metric(metric, skewed_view, 10**9))


def test_only_needed_tables_and_columns_are_read(spark):
    metric = METRICS["stock_sold"]
    plan = plan_of(metric.compute(combined_sales(spark, PATH, metric)))
    assert plan.count("FileScan") == 2 and "orders" not in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_key_figures_join_nothing(spark):
    metric = METRICS["kpi_summary"]
    plan = plan_of(metric.compute(combined_sales(spark, PATH, metric)))
    assert plan.count("FileScan") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", sorted(METRICS))
def test_no_plan_has_a_cartesian_product_or_python(spark, name):
    metric = METRICS[name]
    plan = plan_of(compute_metric(metric, combined_sales(spark, PATH, metric), 10**9))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Expand"):
        assert operator not in plan


def test_lines_are_combined_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        metric = METRICS["location_performance"]
        plan = plan_of(metric.compute(combined_sales(spark, PATH, metric)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # From the scan of the lines up: partial sums, one shuffle, final sums, join.
    lines = plan[plan.index("SortMergeJoin [l_orderkey") :]
    assert lines.index("HashAggregate") < lines.index("Exchange")
    assert lines.index("partial_sum") < lines.index("FileScan")


def without_broadcast(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    return session


def test_orders_are_counted_without_a_shuffle_by_order(spark):
    for name in ("rfm", "avg_order_value"):
        metric = METRICS[name]
        combined = combined_sales(without_broadcast(spark), PATH, metric)
        assert "order_id_distinct" in combined.columns and "order_id" not in combined.columns
        plan = plan_of(compute_metric(metric, combined, 0))
        assert "order_id#" not in plan.replace("order_id_distinct#", "")


def test_lines_are_summed_per_part_and_moment_before_the_parts_are_joined(spark):
    metric = METRICS["product_performance"]
    plan = plan_of(compute_metric(metric, combined_sales(without_broadcast(spark), PATH, metric), 0))
    joined, summed = plan.index("SortMergeJoin [l_partkey"), plan.index("keys=[l_partkey")
    assert joined < summed  # the plan prints from the result down to the tables
