"""The streaming job on files: equal to the batch functions, and safe to restart and replay."""

import os

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.catalogue import METRICS
from tallyhouse.operators.mergeable import STATE_OF, merged, traffic_over_batches
from tallyhouse.plans.microbatch import compute_metric
from tallyhouse.schema import EVENT_FIELDS
from tallyhouse.sinks.publishing import to_kafka_records, to_wire
from tallyhouse.sources.events import parse_events, read_events_stream
from tallyhouse.sources.metric_store import read_metric, stored_batches
from tallyhouse.sources.tables import sales_view
from tallyhouse.streaming import driver
from tallyhouse.streaming.driver import batch_writer, run_stream, write_batch

AUDIT = ("stored_at", "batch_id", "micro_batch_id")


@pytest.fixture(scope="module")
def inbox(spark, tmp_path_factory):
    """Three files of JSON events, with a malformed line in each."""
    folder = tmp_path_factory.mktemp("inbox")
    names = [name for _, name, _ in EVENT_FIELDS]
    sales = sales_view(spark, "/root/testdata/sf0.001", names)
    records = to_kafka_records(to_wire(sales), "Sales ID").limit(600).collect()
    for n in range(3):
        lines = [record.value for record in records[n * 200 : (n + 1) * 200]]
        part = folder / f"part-{n}.json"
        part.write_text("\n".join([*lines, "{broken"]))
        # The stream takes files by the time of their last change.
        os.utime(part, (1_700_000_000 + n, 1_700_000_000 + n))
    return folder


def messages(spark, inbox):
    return read_events_stream(spark, "text", path=str(inbox), maxFilesPerTrigger="1")


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def plain(df):
    return sorted((tuple(r) for r in df.drop(*AUDIT, "recency").collect()), key=repr)


def test_stream_equals_batch_and_restart_adds_nothing(spark, inbox, tmp_path):
    root, checkpoint = str(tmp_path / "metrics"), str(tmp_path / "checkpoint")
    for _ in range(2):
        finish(run_stream(messages(spark, inbox), root, checkpoint, available_now=True))
    assert stored_batches(spark, root, "gender_counts") == [0, 1, 2]
    assert stored_batches(spark, root, "rfm") == [1, 2]
    rejected = read_metric(spark, root, "rejects")
    assert [r.payload for r in rejected.collect()] == ["{broken"] * 3
    errors = read_metric(spark, root, "sales_regression")
    assert errors.count() == 3 and errors.where("mse > 0").count() == 3

    per_batch = read_metric(spark, root, "bounce_rate").groupBy("micro_batch_id")
    assert {r[1] for r in per_batch.agg(F.sum("orders_count")).collect()} == {200}
    last = parse_events(spark.read.text(str(inbox / "part-2.json"))).persist()
    for name, metric in METRICS.items():
        stored = read_metric(spark, root, metric.table).where("micro_batch_id = 2")
        assert plain(stored) == plain(compute_metric(metric, last, 0)), name
    last.unpersist()


def test_source_is_read_once_per_batch(spark, inbox, tmp_path):
    """For metrics, regression and rejects together: Spark counts the rows of every scan."""
    query = run_stream(
        messages(spark, inbox), str(tmp_path / "m"), str(tmp_path / "c"), available_now=True, width=3
    )
    finish(query)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [201] * 3


def test_failing_fit_leaves_the_metrics(spark, inbox, tmp_path, monkeypatch):
    def fail(_):
        raise ValueError("no fit")

    monkeypatch.setattr(driver, "fit_sales_model", fail)
    root = str(tmp_path / "metrics")
    finish(run_stream(messages(spark, inbox), root, str(tmp_path / "c"), available_now=True))
    assert stored_batches(spark, root, "gender_counts") == [0, 1, 2]
    assert stored_batches(spark, root, "sales_regression") == []


def test_only_wanted_fields_are_parsed(spark, inbox):
    text = spark.read.text(str(inbox))
    plan = parse_events(text, ["gender", "age"])._jdf.queryExecution().executedPlan().toString()
    assert "Gender" in plan and "Payment Method" not in plan
    assert parse_events(text, ["gender"]).count() == 600


def test_new_checkpoint_refuses_a_root_in_use(spark, inbox, tmp_path):
    root = str(tmp_path / "metrics")
    some = [METRICS["stock_sold"]]
    finish(run_stream(messages(spark, inbox), root, str(tmp_path / "a"), some, available_now=True))
    with pytest.raises(ValueError, match="one root per checkpoint"):
        run_stream(messages(spark, inbox), root, str(tmp_path / "b"), some, available_now=True)


def test_stream_compacts(spark, inbox, tmp_path):
    root, some = str(tmp_path / "metrics"), [METRICS["stock_sold"]]
    finish(
        run_stream(
            messages(spark, inbox), root, str(tmp_path / "c"), some, available_now=True, compact_every=2
        )
    )
    assert stored_batches(spark, root, "stock_levels") == [1, 2]
    assert read_metric(spark, root, "stock_levels").select("micro_batch_id").distinct().count() == 3


def test_replayed_batch_changes_nothing(spark, sales, tmp_path):
    root = str(tmp_path / "metrics")
    for fused in (True, False):
        write_batch(sales, root, 0, fused=fused)
        assert read_metric(spark, root, "stock_levels").count() == 4
        assert read_metric(spark, root, "rfm", latest=True).count() == 4


def test_empty_batch_is_skipped(spark, sales, tmp_path):
    root = str(tmp_path / "metrics")
    batch_writer(root)(sales.sparkSession.createDataFrame([], "value string"), 5)
    assert stored_batches(spark, root, "gender_counts") == []


def test_nothing_stays_cached(spark, sales, tmp_path):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    write_batch(sales, str(tmp_path / "metrics"), 0)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_preview_shows_the_rows(sales, tmp_path, capsys):
    write_batch(sales, str(tmp_path / "m"), 0, [METRICS["stock_sold"]], preview=True)
    assert "stock_sold" in capsys.readouterr().out


def lossy(spark, tmp_path):
    """Events with an amount too large, one with too many digits, fields of the wrong type, and sound ones."""
    inbox = tmp_path / "lossy"
    inbox.mkdir()
    lines = [
        '{"Gender": "male", "Customer ID": 1, "Total Sales Amount": 1e23, "Order ID": "a"}',
        '{"Gender": "male", "Customer ID": 2, "Total Sales Amount": 1.23456789, "Order ID": "b"}',
        '{"Gender": "male", "Customer ID": "x", "Age": 3.7, "Total Sales Amount": 2, "Order ID": "c"}',
        '{"Gender": "male", "Customer ID": 3, "Total Sales Amount": 2.5, "Order ID": 4, "Age": null}',
        "{broken",
    ]
    (inbox / "part-0.json").write_text("\n".join(lines))
    return inbox, lines


def test_lost_fields_are_counted_and_stored(spark, tmp_path):
    inbox, lines = lossy(spark, tmp_path)
    root = str(tmp_path / "m")
    query = run_stream(messages(spark, inbox), root, str(tmp_path / "c"), available_now=True)
    finish(query)
    stored = {r.payload: r.lost for r in read_metric(spark, root, "losses").collect()}
    amount = "Total Sales Amount"
    assert stored == {lines[0]: [amount], lines[1]: [amount], lines[2]: ["Age", "Customer ID"]}
    counts = {r.field: r.messages for r in read_metric(spark, root, "loss_counts").collect()}
    assert counts == {amount: 2, "Age": 1, "Customer ID": 1}
    assert [r.payload for r in read_metric(spark, root, "rejects").collect()] == ["{broken"]
    # One scan of the source for metrics, counts, losses and rejects
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [5]
    assert read_metric(spark, root, "gender_counts").first().customer_count == 3


def test_a_stored_model_predicts_later_batches(spark, inbox, tmp_path, monkeypatch):
    root, fits = str(tmp_path / "m"), []
    real = driver.fit_sales_model
    monkeypatch.setattr(driver, "fit_sales_model", lambda df: fits.append(1) or real(df))
    some = [METRICS["stock_sold"]]
    finish(
        run_stream(messages(spark, inbox), root, str(tmp_path / "c"), some, available_now=True, refit_every=2)
    )
    assert len(fits) == 2  # batches 0 and 2; batch 1 is predicted by the model of batch 0
    errors = read_metric(spark, root, "sales_regression").orderBy("micro_batch_id").collect()
    assert [(r.micro_batch_id, r.model_batch_id) for r in errors] == [(0, 0), (1, 0), (2, 2)]
    kept = read_metric(spark, root, "sales_predictions")
    assert {r[0] for r in kept.select("micro_batch_id").distinct().collect()} == {1, 2}
    latest = read_metric(spark, root, "sales_predictions", latest=True)
    assert latest.count() == 200 and latest.where("prediction IS NULL").count() == 0
    assert {"transaction_date_readable", "total_sales_amount", "prediction"} <= set(latest.columns)


def test_a_failing_fit_is_stored(spark, inbox, tmp_path, monkeypatch):
    def fail(_):
        raise ValueError("no fit")

    monkeypatch.setattr(driver, "fit_sales_model", fail)
    root = str(tmp_path / "m")
    finish(run_stream(messages(spark, inbox), root, str(tmp_path / "c"), [METRICS["stock_sold"]], available_now=True))
    errors = read_metric(spark, root, "batch_errors").collect()
    assert [(r.task, r.message) for r in errors] == [("regression", "ValueError: no fit")] * 3


def test_stored_states_give_metrics_over_all_batches(spark, inbox, tmp_path):
    root = str(tmp_path / "m")
    finish(run_stream(messages(spark, inbox), root, str(tmp_path / "c"), available_now=True, regression=False))
    everything = parse_events(spark.read.text(str(inbox))).persist()
    for name, state in STATE_OF.items():
        states = read_metric(spark, root, state.table)
        assert states.select("micro_batch_id").distinct().count() == 3
        over = compute_metric(METRICS[name], merged(states.drop(*AUDIT), state), 0)
        assert plain(over) == plain(compute_metric(METRICS[name], everything, 0)), name
    exact = everything.select("customer_id").distinct().count()
    near = traffic_over_batches(read_metric(spark, root, "website_traffic_state")).first()[0]
    assert abs(near - exact) <= 0.05 * exact
    everything.unpersist()


def test_empty_batch_does_not_keep_compaction_from_running(spark, sales, tmp_path):
    root, some = str(tmp_path / "m"), [METRICS["stock_sold"]]
    for batch in range(4):
        write_batch(sales, root, batch, some)
    none = spark.createDataFrame([], "value string")
    batch_writer(root, some, regression=False, compact_every=4)(none, 4)
    assert stored_batches(spark, root, "stock_levels") == [2, 3]
