"""Recorded topics: keys, partitions, offsets, where a stream starts and where it goes on."""

import json
import os
import zlib

import pytest

from tallyhouse.sinks.publishing import publish_events
from tallyhouse.sources.events import parse_events, read_events_stream
from tallyhouse.sources.topic_files import FORMAT, TopicWriter, register_topic_files
from tallyhouse.streaming.driver import run_stream
from tallyhouse.operators.catalogue import METRICS
from tallyhouse.sources.metric_store import read_metric
from test_stream import finish


@pytest.fixture
def topic(spark, tmp_path):
    register_topic_files(spark)
    return {"path": str(tmp_path / "topics"), "topic": "sales"}


def _events(spark, first, end):
    return spark.range(first, end).selectExpr(
        "concat('s', id % 10) AS sales_id", "'north' AS location_store", "int(1) AS quantity_sold", "'bolt' AS product_name", "id"
    )


def _read(spark, topic, **options):
    return spark.read.format(FORMAT).options(**topic, **options).load()


def _publish(spark, topic, first, end, **options):
    publish_events(_events(spark, first, end).repartition(3), FORMAT, **topic, **options)


def test_keys_decide_the_partition_and_offsets_have_no_gap(spark, topic):
    _publish(spark, topic, 0, 40, partitions="4")
    _publish(spark, topic, 40, 60)
    rows = _read(spark, topic).collect()
    assert len(rows) == 60 and {r.topic for r in rows} == {"sales"}
    for row in rows:
        assert row.partition == zlib.crc32(bytes(row.key)) % 4
        assert json.loads(bytes(row.value))["Sales ID"] == bytes(row.key).decode()
    for p in range(4):
        offsets = sorted(r.offset for r in rows if r.partition == p)
        assert offsets == list(range(len(offsets)))
    assert parse_events(_read(spark, topic), ["quantity_sold"]).count() == 60
    behind = json.dumps({str(p): 3 for p in range(4)})
    assert _read(spark, topic, startingOffsets=behind).where("offset < 3").count() == 0


def test_a_writer_that_failed_leaves_nothing(spark, topic):
    _publish(spark, topic, 0, 10, partitions="1")
    bad = _events(spark, 0, 10).selectExpr("sales_id AS key", "if(id = 7, raise_error('no'), 'x') AS value")
    with pytest.raises(Exception, match="no"):
        bad.write.format(FORMAT).options(**topic).mode("append").save()
    assert _read(spark, topic).count() == 10
    writer = TopicWriter(topic)
    from pyspark.sql import Row

    written = writer.write(iter([Row(key=None, value=None)]))
    writer.abort([written, None])
    assert not os.path.exists(written.segments[0][1])
    writer.commit([writer.write(iter([Row(key=None, value=None)]))])
    last = _read(spark, topic).orderBy("offset").collect()[-1]
    assert (last.offset, last.partition, last.key, last.value) == (10, 0, None, None)


def test_stream_starts_at_the_end_and_resumes_by_offset(spark, topic, tmp_path):
    _publish(spark, topic, 0, 30, partitions="2")
    root, checkpoint, some = str(tmp_path / "m"), str(tmp_path / "c"), [METRICS["stock_sold"]]

    def run(**options):
        messages = read_events_stream(spark, FORMAT, **topic, **options)
        finish(run_stream(messages, root, checkpoint, some, available_now=True, regression=False, states=False))

    def stored():
        empty = METRICS["stock_sold"].compute(_events(spark, 0, 0)).schema
        return [r.stock_sold for r in read_metric(spark, root, "stock_levels", empty_schema=empty).collect()]

    run()
    assert stored() == []  # "latest": what was there before the stream is not read
    _publish(spark, topic, 30, 37)
    run()
    assert stored() == [7]
    _publish(spark, topic, 37, 40)
    run()
    run()
    assert sorted(stored()) == [3, 7]


def test_stream_from_the_beginning(spark, topic, tmp_path):
    _publish(spark, topic, 0, 30, partitions="2")
    messages = read_events_stream(spark, FORMAT, **topic, startingOffsets="earliest")
    root = str(tmp_path / "m")
    some = [METRICS["stock_sold"]]
    finish(run_stream(messages, root, str(tmp_path / "c"), some, available_now=True, regression=False))
    assert [r.stock_sold for r in read_metric(spark, root, "stock_levels").collect()] == [30]
