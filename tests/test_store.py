"""Stored metrics: appending, replacing, replays, compaction, and what a reader sees."""

import os
from datetime import datetime, timezone
from decimal import Decimal

import pytest

from tallyhouse.operators import kpi, product
from tallyhouse.plans import serving
from tallyhouse.sinks.metrics import audited, batch_attempt, store_metric, write_rows
from tallyhouse.sources.metric_store import (
    committed,
    compact_batches,
    expire_batches,
    metric_path,
    newest_batch,
    path_holds_files,
    read_metric,
    stored_batches,
)

NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "metrics")


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_appended_batches_add_up(spark, sales, root, fmt):
    for batch in (0, 1):
        store_metric(product.stock_sold(sales), root, "stock_levels", batch, fmt=fmt)
    stored = read_metric(spark, root, "stock_levels", fmt=fmt)
    assert stored.count() == 8
    assert dict(stored.dtypes)["micro_batch_id"] == "bigint"
    total = serving.cumulative(stored, ["product_name"], ["stock_sold"])
    assert {r.product_name: r.stock_sold for r in total.collect()}["bolt"] == 24


def test_replayed_batch_replaces_itself(spark, sales, root):
    for _ in range(2):
        store_metric(product.stock_sold(sales), root, "stock_levels", 0)
    assert read_metric(spark, root, "stock_levels").count() == 4
    assert committed(spark, root) == {0: 1}


def test_reader_of_a_replaced_metric_sees_the_newest_batch(spark, sales, root):
    for batch in (2, 10):
        store_metric(kpi.kpi_summary(sales.limit(batch)), root, "kpis", batch)
    newest = read_metric(spark, root, "kpis", latest=True)
    assert [row.micro_batch_id for row in newest.collect()] == [10]
    assert read_metric(spark, root, "kpis").count() == 2


def test_newest_batch_reads_one_directory(spark, sales, root):
    for batch in range(3):
        store_metric(product.stock_sold(sales), root, "stock_levels", batch)
    newest = read_metric(spark, root, "stock_levels", latest=True)
    assert len(newest.inputFiles()) > 0
    assert all("/batch=2/attempt=0/" in name for name in newest.inputFiles())
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Subquery" not in plan


def test_batch_of_a_writer_that_failed_is_not_seen(spark, sales, root):
    store_metric(product.stock_sold(sales), root, "stock_levels", 0)
    with pytest.raises(RuntimeError), batch_attempt(spark, root, 1) as attempt:
        write_rows(product.stock_sold(sales), root, "stock_levels", 1, attempt)
        raise RuntimeError("between two tables")
    assert newest_batch(spark, root) == 0
    assert read_metric(spark, root, "stock_levels").count() == 4
    store_metric(product.stock_sold(sales), root, "stock_levels", 1)
    assert read_metric(spark, root, "stock_levels").count() == 8


def test_reader_is_not_disturbed_by_a_replay(spark, sales, root):
    store_metric(product.stock_sold(sales), root, "stock_levels", 0)
    reader = read_metric(spark, root, "stock_levels")
    with batch_attempt(spark, root, 0) as attempt:
        write_rows(product.stock_sold(sales.limit(1)), root, "stock_levels", 0, attempt)
        assert reader.count() == read_metric(spark, root, "stock_levels").count() == 4
    assert reader.count() == 4
    assert read_metric(spark, root, "stock_levels").count() == 1


def test_compaction_keeps_totals_and_shortens_lists(spark, sales, root):
    def total():
        rows = read_metric(spark, root, "stock_levels")
        sums = serving.cumulative(rows, ["product_name"], ["stock_sold"]).collect()
        ids = {r.micro_batch_id for r in rows.select("micro_batch_id").distinct().collect()}
        return {r.product_name: r.stock_sold for r in sums}["bolt"], len(ids)

    for batch in range(9):
        store_metric(product.stock_sold(sales), root, "stock_levels", batch)
        if batch in (4, 6, 8):
            before = total()
            compact_batches(spark, root, ["stock_levels"])
            assert total() == before == (12 * (batch + 1), batch + 1)
    assert stored_batches(spark, root, "stock_levels") == [7, 8]
    assert min(committed(spark, root)) > 4
    assert not path_holds_files(spark, f"{metric_path(root, 'stock_levels')}/batch=1")


def test_old_batches_expire(spark, sales, root):
    for batch in (0, 1, 2, 10):
        store_metric(kpi.kpi_summary(sales), root, "kpis", batch, keep=3)
    assert stored_batches(spark, root, "kpis") == [1, 2, 10]
    assert expire_batches(spark, root, "kpis", keep=1) == [1, 2]
    with pytest.raises(ValueError):
        expire_batches(spark, root, "kpis", keep=0)


def test_metric_without_a_batch_reads_as_empty_when_asked(spark, sales, root):
    schema = kpi.kpi_summary(sales).schema
    empty = read_metric(spark, root, "kpis", empty_schema=schema)
    assert serving.latest_kpis(empty).count() == 0
    with pytest.raises(LookupError):
        read_metric(spark, root, "kpis")


def test_first_batch_of_a_writer_that_failed_is_not_seen(spark, sales, root):
    rows = product.stock_sold(sales)
    with pytest.raises(RuntimeError), batch_attempt(spark, root, 0) as attempt:
        write_rows(rows, root, "stock_levels", 0, attempt)
        raise RuntimeError("between two tables")
    with pytest.raises(LookupError):
        read_metric(spark, root, "stock_levels")
    assert read_metric(spark, root, "stock_levels", empty_schema=rows.schema).count() == 0
    assert read_metric(spark, root, "stock_levels", empty_schema=rows.schema).columns == rows.columns


def test_compaction_in_levels(spark, sales, root):
    """Few folders, no row written more often than there are levels, and reads as of older batches."""
    for batch in range(12):
        store_metric(product.stock_sold(sales), root, "stock_levels", batch)
        compact_batches(spark, root, ["stock_levels"], keep=1, together=3)
        for upto in (None, batch, batch // 2):
            rows = read_metric(spark, root, "stock_levels", upto=upto)
            ids = [r[0] for r in rows.select("micro_batch_id").distinct().collect()]
            assert sorted(ids) == list(range((batch if upto is None else upto) + 1))
            assert rows.count() == 4 * len(ids)
    folders = os.listdir(metric_path(root, "stock_levels"))
    levels = sorted(f for f in folders if f.startswith("compacted="))
    assert len(levels) <= 8 and any(f.startswith("compacted=2.0.") for f in levels)
    newest = read_metric(spark, root, "stock_levels", latest=True)
    assert [r.micro_batch_id for r in newest.select("micro_batch_id").distinct().collect()] == [11]


def test_totals_of_stored_amounts_are_exact(spark, root):
    large = Decimal("12345678901234.1234")
    rows = spark.createDataFrame([(large, "a")], "total_sales_amount decimal(28,6), product_name string")
    for batch in (0, 1):
        store_metric(rows, root, "profit", batch)
    total = serving.cumulative(
        read_metric(spark, root, "profit"), ["product_name"], ["total_sales_amount"]
    )
    assert total.first().total_sales_amount == 2 * large


def test_audit_columns(sales):
    stored = audited(product.stock_sold(sales), NOW, row_uuid=True).collect()
    assert len({row.batch_id for row in stored}) == 4
    assert len({row.stored_at for row in stored}) == 1
    assert "batch_id" not in audited(product.stock_sold(sales), NOW).columns
