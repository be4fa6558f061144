"""The insight report and the file it is written to."""

from pathlib import Path

from pyspark.sql import functions as F

from tallyhouse.operators.catalogue import METRICS
from tallyhouse.plans import insights, serving
from tallyhouse.sinks.publishing import write_report
from tallyhouse.streaming.driver import write_batch


def report_of(spark, sales, root):
    write_batch(sales, root, 0, [METRICS[name] for name in insights.REPORT_METRICS])
    return insights.insights_report(insights.stored_metrics(spark, root))


def test_lines(spark, sales, tmp_path):
    lines = [row.text for row in report_of(spark, sales, str(tmp_path)).collect()]
    for line in (
        "E-commerce Dashboard Insights Report",
        "1. Payment Method Distribution Overview",
        "Gift Card: 5 customers",
        "1970-01-02 00:00:00: Quantity Sold - 3, Total Sales - $30.30",
        "Male Count - 3 customers",
        "Female Count - 2 customers",
        "Monetary - $60.60",
        "Total Sales - $30.30, Total Discount - $2.00",
        "Location - Goa, Total Sales - $60.60, Total Quantity Sold - 6 units",
        "Total Sales: $282.80",
        "Total Inventory Value: $28.00",
        "| bolt | 6.0 |",
    ):
        assert line in lines, line


def test_empty_store_gives_zeros_and_no_lists(spark, tmp_path):
    report = insights.insights_report(insights.stored_metrics(spark, str(tmp_path)))
    lines = [row.text for row in report.collect()]
    assert "Revenue: $0.00" in lines and "Male Count - 0 customers" in lines
    assert not any(line.startswith("Location - ") for line in lines if line)


def test_partial_store(spark, sales, tmp_path):
    write_batch(sales, str(tmp_path), 0, [METRICS["location_performance"]])
    report = insights.insights_report(insights.stored_metrics(spark, str(tmp_path)))
    lines = [row.text for row in report.collect()]
    assert "Location - Goa, Total Sales - $60.60, Total Quantity Sold - 6 units" in lines
    assert "Revenue: $0.00" in lines


def test_no_line_is_lost_for_a_missing_figure(spark, sales, tmp_path):
    gaps = sales.withColumn("discount_amount", F.lit(None).cast("decimal(28,6)")).withColumn(
        "total_sales_amount",
        F.when(F.col("location_store") != "Goa", F.col("total_sales_amount")),
    )
    lines = [row.text for row in report_of(spark, gaps, str(tmp_path)).collect()]
    assert sum("Total Discount - None" in line for line in lines if line) == 4
    assert "Location - Goa, Total Sales - None, Total Quantity Sold - 6 units" in lines
    assert sum(line.startswith("Monetary - ") for line in lines if line) == 4


def test_limits_are_arguments(spark, sales, tmp_path):
    write_batch(sales, str(tmp_path), 0, [METRICS[name] for name in insights.REPORT_METRICS])
    metrics = insights.stored_metrics(spark, str(tmp_path))
    one = insights.insights_report(metrics, series_rows=1, point_rows=1, turnover_rows=1)
    full = insights.insights_report(metrics, series_rows=None, point_rows=None, turnover_rows=None)
    assert one.where("section = 8 AND seq > 1").count() == 1
    assert full.where("section = 8 AND seq > 1").count() == 4


def test_file_holds_the_lines_in_order(spark, sales, tmp_path):
    report = report_of(spark, sales, str(tmp_path / "metrics"))
    write_report(report, str(tmp_path / "report"))
    parts = sorted(Path(tmp_path / "report").glob("part-*"))
    written = [line for part in parts for line in part.read_text().splitlines()]
    assert written[0] == insights.TITLE
    places = [written.index(title) for title in insights.SECTIONS]
    assert places == sorted(places)
    assert len(written) == report.where("text IS NOT NULL").count()


def test_gender_totals_join_spellings(spark):
    counts = spark.createDataFrame(
        [("male", 1), ("Male", 2), ("FEMALE", 4), (None, 8), ("other", 16)],
        "gender string, customer_count bigint",
    )
    assert tuple(serving.gender_totals(counts).first()) == (3, 4)
    assert tuple(serving.gender_totals(counts.limit(0)).first()) == (0, 0)


def test_histogram_buckets(spark):
    values = spark.createDataFrame([(-1.0,), (0.0,), (49.99,), (50.0,)], "monetary double")
    buckets = {row.bucket: row.customers for row in serving.monetary_histogram(values).collect()}
    assert buckets == {-50.0: 1, 0.0: 2, 50.0: 1}


def test_trend_of_a_line(spark):
    points = spark.createDataFrame(
        [("a", 10.0, 3.0), ("b", 20.0, 5.0), ("b", 10.0, 2.0)],
        "product_name string, total_sales_amount double, total_discount_amount double",
    )
    line = serving.profitability_trend(points).first()
    assert (round(line.slope, 9), round(line.intercept, 9), line.points) == (0.2, 1.0, 2)
