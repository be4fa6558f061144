"""Progress of streaming queries as stored rows, with a processing-time trigger and with a query that fails."""

import time

import pytest
from pyspark.errors import StreamingQueryException
from test_stream import finish, inbox, messages  # noqa: F401

from tallyhouse.operators.catalogue import METRICS
from tallyhouse.streaming import driver
from tallyhouse.streaming.driver import await_streams, run_stream
from tallyhouse.streaming.progress import log_progress, read_progress


def _wait(condition, seconds=60):
    end = time.monotonic() + seconds
    while not condition():
        assert time.monotonic() < end, "nothing happened"
        time.sleep(0.2)


@pytest.fixture
def log(spark, tmp_path):
    root = str(tmp_path / "progress")
    listener = log_progress(spark, root)
    yield root
    spark.streams.removeListener(listener)


def test_batches_of_a_timed_stream(spark, inbox, tmp_path, log):  # noqa: F811
    assert read_progress(spark, log).count() == 0
    some = [METRICS["stock_sold"]]
    query = run_stream(
        messages(spark, inbox), str(tmp_path / "m"), str(tmp_path / "c"), some, trigger="1 second", regression=False
    )
    _wait(lambda: read_progress(spark, log).where("event = 'progress' AND input_rows > 0").count() == 3)
    query.stop()
    _wait(lambda: read_progress(spark, log).where("event = 'terminated'").count() == 1)
    rows = read_progress(spark, log).where("query = '%s'" % query.id)
    batches = rows.where("event = 'progress' AND input_rows > 0").orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows) for r in batches] == [(0, 201), (1, 201), (2, 201)]
    assert all(r.duration_ms > 0 and r.moment for r in batches)
    assert rows.where("event = 'started'").count() == 1 and rows.where("error IS NOT NULL").count() == 0


def test_a_query_that_fails(spark, inbox, tmp_path, log, monkeypatch):  # noqa: F811
    def fail(*_, **__):
        raise RuntimeError("disk is full")

    monkeypatch.setattr(driver, "write_batch", fail)
    spark.streams.resetTerminated()
    run_stream(messages(spark, inbox), str(tmp_path / "m"), str(tmp_path / "c"), trigger="1 second")
    with pytest.raises(StreamingQueryException, match="disk is full"):
        await_streams(spark)
    _wait(lambda: read_progress(spark, log).where("event = 'terminated'").count() == 1)
    assert "disk is full" in read_progress(spark, log).where("event = 'terminated'").first().error
    spark.streams.resetTerminated()


def test_a_query_that_ends_by_itself(spark, inbox, tmp_path, log):  # noqa: F811
    some = [METRICS["stock_sold"]]
    finish(run_stream(messages(spark, inbox), str(tmp_path / "m"), str(tmp_path / "c"), some, available_now=True))
    _wait(lambda: read_progress(spark, log).where("event = 'terminated'").count() == 1)
    assert read_progress(spark, log).where("event = 'progress'").agg({"input_rows": "sum"}).first()[0] == 603
